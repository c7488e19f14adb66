"""Filling containers of fixed capacity with texts of varying length."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Containers that a group fills, and pieces that it holds at most, both on average. A group leaves about one badly filled
#: container behind, and is packed in one task.
GROUP_CONTAINERS = 1_000
GROUP_PIECES = 20_000


def initial_bins(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of pieces per container by best fit, in the order given: a start that leaves the rest to the search."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for i, size in enumerate(sizes):
        at = bisect_left(room, (size, -1))
        if at == len(room):
            bins.append([i])
            free, b = capacity - size, len(bins) - 1
        else:
            free, b = room.pop(at)
            bins[b].append(i)
            free -= size
        if free:
            insort(room, (free, b))
    return bins


class _Search:
    """State of the local search: sizes, the container of each piece, and the fill and content of each container."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.size = np.asarray(sizes, dtype=np.int64)
        self.capacity = capacity
        self.where = np.empty(len(sizes), dtype=np.int64)
        self.content = [set(b) for b in bins]
        for b, members in enumerate(bins):
            self.where[members] = b
        self.fill = np.bincount(self.where, weights=self.size, minlength=len(bins)).astype(np.int64)

    def put(self, i: int, b: int) -> None:
        old = self.where[i]
        self.content[old].discard(i)
        self.content[b].add(i)
        self.fill[old] -= self.size[i]
        self.fill[b] += self.size[i]
        self.where[i] = b

    def gains(self, s: int, pieces: np.ndarray, gain: np.ndarray) -> int | None:
        """The piece of another container in whose place ``gain`` more tokens fill that container best, if any raises the squared fill."""
        target = self.where[pieces]
        left = self.capacity - self.fill[target] - gain
        ok = (gain > 0) & (left >= 0) & (target != s) & (self.fill[target] - self.fill[s] + gain > 0)
        return int(np.argmin(np.where(ok, left, self.capacity))) if ok.any() else None

    def step(self, s: int, others: np.ndarray, pieces: np.ndarray) -> bool:
        """One move, one-for-one or two-for-one exchange out of container ``s`` that raises the sum of squared fills."""
        size, fill = self.size, self.fill
        members = sorted(self.content[s], key=lambda i: (-size[i], i))
        for a in members:
            left = self.capacity - fill[others] - size[a]
            fits = (left >= 0) & (others != s) & (fill[others] + size[a] > fill[s])
            if fits.any():
                self.put(a, int(others[np.argmin(np.where(fits, left, self.capacity))]))
                return True
        for a in members:
            at = self.gains(s, pieces, size[a] - size[pieces])
            if at is not None:
                b, t = int(pieces[at]), int(self.where[pieces[at]])
                self.put(b, s)
                self.put(a, t)
                return True
        ascending = np.array(members[::-1])
        for a in members:
            partners = ascending[ascending != a]
            if not len(partners):
                break
            # For each piece c elsewhere the largest partner of a with which both still fit in its place.
            room = size[pieces] + self.capacity - fill[self.where[pieces]] - size[a]
            best = np.searchsorted(size[partners], room, side="right") - 1
            both = np.where(best >= 0, size[a] + size[partners[np.maximum(best, 0)]], 0)
            at = self.gains(s, pieces, both - size[pieces])
            if at is not None:
                c, t, b = int(pieces[at]), int(self.where[pieces[at]]), int(partners[best[at]])
                self.put(c, s)
                self.put(a, t)
                self.put(b, t)
                return True
        return False


def improve(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Local search that only ever raises the sum of squared fills, until no step does.

    Every container with room gives, the emptiest first: a piece moves to another container it fits in, or is
    exchanged for a smaller piece there, or two pieces are exchanged for one that is smaller than both together. The
    sum of squared fills is whole, bounded and grows with every step, so the search ends; containers without pieces drop out.
    """
    state = _Search(sizes, bins, capacity)
    better = True
    while better:
        better = False
        for s in np.argsort(state.fill, kind="stable"):
            while 0 < state.fill[s] < capacity:
                others = np.flatnonzero((state.fill > 0) & (state.fill < capacity))
                pieces = np.flatnonzero(((state.fill > 0) & (state.fill < capacity))[state.where])
                if not state.step(int(s), others, pieces):
                    break
                better = True
    return [sorted(c) for c in state.content if c]


def pack(sizes: list[int], capacity: int) -> tuple[list[list[int]], list[list[int]]]:
    """Containers as lists of indices into ``sizes``, at the start of the search and at its end; every size must be in 1..capacity."""
    start = initial_bins(sizes, capacity)
    return start, improve(sizes, start, capacity) if sizes else []


PACK_SCHEMA = "pack_kind string, container string, doc_id long, piece int, from_token long, n_tokens int, start_container string"


def pack_documents(counts: DataFrame, kinds: list[tuple[str, int]], group_containers: int = GROUP_CONTAINERS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Assign every document to a container of each kind (name, capacity).

    ``counts`` has doc_id and n_tokens. Returns (pack_kind, container, doc_id, piece, from_token, n_tokens, start_container),
    the last being the container before the local search. A document is
    split only if it is longer than the capacity: into full containers of its own and a rest that is packed with others.
    Documents without tokens take no room and are in no container. A doc_id that occurs twice is packed twice.

    Pieces are dealt to groups by a random hash of document and piece, so no source or length can make a group hot, and each
    group is packed on its own by swap-based local search from a best fit in the order of ids. The number of groups follows the
    number of pieces; each costs at most a container or so, thousands of which come out of it.
    """
    if not kinds or any(c < 1 for _, c in kinds):
        raise ValueError("capacities must be positive")
    kind = F.explode(F.array(*(F.struct(F.lit(n).alias("pack_kind"), F.lit(c).cast("long").alias("capacity")) for n, c in kinds)))
    docs = counts.filter(F.col("n_tokens") > 0).select(F.col("doc_id").cast("long"), F.col("n_tokens").cast("long"), kind.alias("k")).select("doc_id", "n_tokens", "k.*")
    pieces = docs.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / F.col("capacity")))))
    pieces = pieces.withColumn("from_token", F.col("piece") * F.col("capacity")).withColumn("size", F.least(F.col("capacity"), F.col("n_tokens") - F.col("from_token")))
    full = pieces.filter(F.col("size") == F.col("capacity")).select(
        "pack_kind", F.concat_ws("-", "pack_kind", F.lit("d"), "doc_id", "piece").alias("container"), "doc_id", F.col("piece").cast("int"), "from_token", F.col("size").cast("int").alias("n_tokens")
    )
    full = full.withColumn("start_container", F.col("container"))
    rest = pieces.filter(F.col("size") < F.col("capacity"))
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()
    groups = {name: max(1, math.ceil(size["t"] / c / group_containers), math.ceil(size["n"] / group_pieces)) for name, c in kinds}
    of_kind = F.create_map(*(F.lit(x) for name, n in groups.items() for x in (name, n)))[F.col("pack_kind")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "from_token"], kind="stable").reset_index(drop=True)
        capacity, name, group = int(pdf["capacity"].iloc[0]), pdf["pack_kind"].iloc[0], int(pdf["grp"].iloc[0])
        labels = []
        for bins in pack(pdf["size"].tolist(), capacity):
            label = [""] * len(pdf)
            for b, members in enumerate(bins):
                for i in members:
                    label[i] = f"{name}-g{group}-{b}"
            labels.append(label)
        start, label = labels
        return pd.DataFrame({"pack_kind": pdf["pack_kind"], "container": label, "doc_id": pdf["doc_id"], "piece": pdf["piece"].astype("int32"), "from_token": pdf["from_token"], "n_tokens": pdf["size"].astype("int32"), "start_container": start})

    grouped = rest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece"), of_kind).cast("int"))
    # A fixed number of partitions: groups are small in bytes but costly, and must not be coalesced into few tasks.
    packed = grouped.repartition(sum(groups.values()), "pack_kind", "grp").groupBy("pack_kind", "grp").applyInPandas(run, PACK_SCHEMA)
    return full.unionByName(packed)


def packing_report(packed: DataFrame, kinds: list[tuple[str, int]]) -> DataFrame:
    """Per kind: containers used before and after the search, tokens, the least number of containers possible by volume, and the share of room used."""
    capacity = F.create_map(*(F.lit(x) for n, c in kinds for x in (n, c)))[F.col("pack_kind")]
    used = packed.groupBy("pack_kind", "container").agg(F.sum("n_tokens").alias("fill"), F.count(F.lit(1)).alias("pieces"))
    out = used.groupBy("pack_kind").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("pieces").alias("n_pieces"), F.sum("fill").alias("n_tokens"), F.max("fill").alias("largest_fill"))
    start = packed.groupBy("pack_kind").agg(F.count_distinct("start_container").alias("start_containers"))
    return out.join(start, "pack_kind").select("*", F.ceil(F.col("n_tokens") / capacity).alias("least_containers"), (F.col("n_tokens") / (F.col("n_containers") * capacity)).alias("share_used"))
