"""References to parent rows that are missing, withdrawn or not there yet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvinlake.operators import bloom
from kelvinlake.session import written


@dataclass(frozen=True)
class Reference:
    """``child_column`` of ``child_table`` points to ``parent`` rows.

    ``child_keys`` and ``parent_keys`` are the full key (with the columns that scope it), in the same order.
    """

    child_table: str
    child_id: str
    child_column: str
    child_keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]


def _parent_intervals(parents: dict[str, DataFrame], refs: Sequence[Reference], since: str, until: str) -> DataFrame:
    """Long table of the times parent keys live: (parent, k1, k2, live_from, live_to), reduced before any join.

    Rows of a key that end at the same time (or never) are one interval from the earliest start, so repeated
    deliveries of one parent collapse on the map side.
    """
    wanted = dict.fromkeys((r.parent, r.parent_keys) for r in refs)
    parts = []
    for name, keys in wanted:
        k1, k2 = keys[0], keys[1] if len(keys) > 1 else None
        parts.append(
            parents[name]
            .filter(F.col(since).isNotNull())
            .select(
                F.lit(name).alias("parent"),
                F.col(k1).cast("long").alias("k1"),
                (F.col(k2).cast("long") if k2 else F.lit(0).cast("long")).alias("k2"),
                F.col(since).alias("live_from"),
                F.col(until).alias("live_to"),
            )
            .filter(F.col("k1").isNotNull() & F.col("k2").isNotNull())
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("parent", "k1", "k2", "live_to").agg(F.min("live_from").alias("live_from"))


def _child_references(children: dict[str, DataFrame], refs: Sequence[Reference], at: str) -> DataFrame:
    """Long table of references; each child table is read once, whatever the number of its columns."""
    parts = []
    for name in dict.fromkeys(r.child_table for r in refs):
        own = [r for r in refs if r.child_table == name]
        entries = F.array(
            *(
                F.struct(
                    F.lit(r.child_column).alias("child_column"),
                    F.lit(r.parent).alias("parent"),
                    F.col(r.child_column).isNotNull().alias("present"),
                    F.col(r.child_keys[0]).cast("long").alias("k1"),
                    (F.col(r.child_keys[1]).cast("long") if len(r.child_keys) > 1 else F.lit(0).cast("long")).alias("k2"),
                )
                for r in own
            )
        )
        parts.append(
            children[name]
            .select(F.lit(name).alias("child_table"), F.col(own[0].child_id).cast("long").alias("child_id"), F.col(at).alias("at"), F.explode(entries).alias("e"))
            .select("child_table", "child_id", "at", "e.*")
            .filter("present")
            .drop("present")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def find_orphans(
    children: dict[str, DataFrame],
    parents: dict[str, DataFrame],
    refs: Sequence[Reference],
    at: str = "ingested_at",
    since: str = "ingested_at",
    until: str = "deleted_at",
) -> DataFrame:
    """Every reference for which no parent row with its key lives at the child's time.

    Returns (child_table, child_column, child_id, at). A parent lives from ``since`` up to but not including
    ``until`` (null: for ever). A null reference is not a case; a reference whose scoping key is null, or whose
    child has no time, resolves to nothing and is an orphan, as is every reference into an empty parent table. 0 is a value
    like any other. Repeated child rows are reported once each.

    Method: a Bloom filter of all parent keys (bounded size, see ``bloom.MAX_BITS``) proves definite orphans
    without a shuffle. The filter-positive references are reduced on the map side to distinct (key, time)
    pairs, which is where a hot key shrinks, and only those are verified by an exact anti join on key and
    interval. A second filter over the failed pairs keeps the join back to child rows as small as its result.
    """
    lives = _parent_intervals(parents, refs, since, until)
    named = _child_references(children, refs, at)
    n_parents = sum(parents[p].count() for p in dict.fromkeys(r.parent for r in refs))
    keys = ("parent", "k1", "k2")
    if n_parents == 0:
        return named.select("child_table", "child_column", "child_id", "at")
    known = bloom.build(lives, *keys, expected=n_parents)
    usable = F.col("k1").isNotNull() & F.col("k2").isNotNull() & F.col("at").isNotNull()
    positive = usable & bloom.might_contain(known, *keys)
    definite = named.filter(~positive)

    pairs = named.filter(positive).select(*keys, "at").distinct()
    failed = pairs.alias("c").join(
        lives.alias("p"),
        (F.col("c.parent") == F.col("p.parent"))
        & (F.col("c.k1") == F.col("p.k1"))
        & (F.col("c.k2") == F.col("p.k2"))
        & (F.col("p.live_from") <= F.col("c.at"))
        & (F.col("p.live_to").isNull() | (F.col("p.live_to") > F.col("c.at"))),
        "left_anti",
    )
    failed = written(failed, "orphan-pairs")
    n_failed = failed.count()
    columns = ["child_table", "child_column", "child_id", "at"]
    if n_failed == 0:
        return definite.select(*columns)
    bad = bloom.build(failed, *keys, "at", expected=n_failed)
    suspects = named.filter(positive & bloom.might_contain(bad, *keys, "at"))
    verified = suspects.join(failed, [*keys, "at"], "left_semi")
    return definite.select(*columns).unionByName(verified.select(*columns))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per child table, column and month (null where the child has no time)."""
    return orphans.groupBy("child_table", "child_column", F.date_format("at", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n_orphans"))
