"""Deeply nested JSON as an adjacency table, and flat entity tables with parent links."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "doc_id long, node_id int, parent_id int, label string, ordinal int, kind string, scalar string, "
    "path string, owner_id int"
)
_NODE_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("node_id", pa.int32()),
        ("parent_id", pa.int32()),
        ("label", pa.string()),
        ("ordinal", pa.int32()),
        ("kind", pa.string()),
        ("scalar", pa.string()),
        ("path", pa.string()),
        ("owner_id", pa.int32()),
    ]
)
#: Arrow batches are flushed at this many nodes, so a long document does not grow one batch without end.
FLUSH_NODES = 50_000


def parse_document(text: str | None) -> dict | None:
    """The JSON object a text holds, or None.

    A text that is a JSON string is read once more as the document inside it. Anything that is not one
    complete JSON object (null, blank, cut off, an array, trailing characters) has no document.
    """
    if not text:
        return None
    try:
        value = json.loads(text)
        if isinstance(value, str):
            value = json.loads(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def kind_of(value) -> str:
    """JSON kind: object, array, string, boolean, number or null."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    if isinstance(value, str):
        return "string"
    return "array" if isinstance(value, list) else "object"


def scalar_text(value) -> str | None:
    """A scalar as text: strings as they are, the rest in JSON notation, null as null."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value)


def as_elements(value) -> list:
    """The elements of an array place: a lone object counts as an array of one."""
    if isinstance(value, list):
        return value
    return [value] if isinstance(value, dict) else []


def walk(document: dict, array_paths: frozenset[str]) -> Iterator[tuple]:
    """Nodes of one document in pre-order, with an explicit stack.

    ``array_paths`` are places where an array is usual: a lone object there becomes an array of one. The path of
    an array's elements ends in ``[]``. ``owner_id`` is the nearest object held in an array (the root, 0, if none).
    """
    counter = 0
    # value, parent, label, ordinal, path, owner
    stack = [(document, -1, None, -1, "", 0)]
    while stack:
        value, parent, label, ordinal, path, owner = stack.pop()
        if isinstance(value, dict) and path in array_paths:
            value = [value]
        node = counter
        counter += 1
        kind = kind_of(value)
        yield (node, parent, label, ordinal, kind, scalar_text(value) if kind not in ("object", "array") else None, path, owner)
        if kind == "object":
            held = node if path.endswith("[]") else owner
            children = [(v, node, k, -1, f"{path}.{k}" if path else k, held) for k, v in value.items()]
            stack.extend(reversed(children))
        elif kind == "array":
            children = [(v, node, None, i, f"{path}[]", owner) for i, v in enumerate(value)]
            stack.extend(reversed(children))


def shred(df: DataFrame, id_col: str, json_col: str, array_paths: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """Shred the documents of ``json_col`` into an adjacency table, one row per JSON node.

    Columns: doc_id, node_id (pre-order, root 0), parent_id (-1 at the root), label (key in the parent object),
    ordinal (place in the parent array, else -1), kind, scalar (text), path, owner_id.

    ``keep`` prunes the table to the object nodes of these element paths and their scalar children. Rows with a null id, and texts that hold no complete object, give no nodes. Keys repeated inside one
    object: the last one counts. Narrow: no shuffle, each document is walked where it is read.
    """
    arrays, wanted = frozenset(array_paths), frozenset(keep) if keep is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_NODE_ARROW)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _NODE_ARROW.types, strict=True)], schema=_NODE_ARROW)
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                document = parse_document(text)
                if document is None or doc_id is None:
                    continue
                for node in walk(document, arrays):
                    if wanted is None or (node[6] in wanted if node[4] == "object" else node[4] != "array" and node[6].rpartition(".")[0] in wanted):
                        rows.append((doc_id, *node))
                if len(rows) >= FLUSH_NODES:
                    yield flush()
        if rows:
            yield flush()

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(json_col).alias("json"))
    return source.mapInArrow(run, NODE_SCHEMA)


def entities(nodes: DataFrame, branches: Mapping[str, Sequence[str]]) -> DataFrame:
    """The entity tables of several branches as one: a row per object held in an array of one of the element paths.

    ``branches`` maps an element path to the scalars wanted of it. Columns: doc_id, entity_id, branch, owner_id
    (entity_id of the object one level up, 0 for the document), pos (place in its array), and a text column
    ``v_<name>`` per scalar of any branch. Object nodes are joined with their scalar children on (doc_id, object) and pivoted,
    as one aggregation by that key: the nodes of an object leave a task as one row, so what is shuffled
    is entities, not nodes. A missing or null scalar is null.
    """
    paths = list(branches)
    number = F.lit(None).cast("int")
    for i, p in enumerate(paths):
        number = F.when(F.col("path") == p, i).otherwise(number)
    held = (F.col("kind") == "object") & F.col("path").isin(paths)
    scalars = sorted({s for names in branches.values() for s in names})
    leaf = F.col("path").isin([f"{p}.{s}" for p, names in branches.items() for s in names]) & ~F.col("kind").isin("object", "array")
    keyed = nodes.filter(held | leaf).withColumns({"entity_id": F.when(held, F.col("node_id")).otherwise(F.col("parent_id")), "held": held})
    whole = keyed.groupBy("doc_id", "entity_id").agg(
        F.max(F.when(F.col("held"), number)).alias("number"),
        F.max(F.when(F.col("held"), F.col("owner_id"))).alias("owner_id"),
        F.max(F.when(F.col("held"), F.col("ordinal"))).alias("pos"),
        *(F.max(F.when(~F.col("held") & (F.col("label") == s), F.col("scalar"))).alias(f"v_{s}") for s in scalars),
    )
    names = F.array(*(F.lit(p) for p in paths))
    return whole.filter("number IS NOT NULL").select("doc_id", "entity_id", F.get(names, F.col("number")).alias("branch"), "owner_id", "pos", *(f"v_{s}" for s in scalars))


def with_places(entity: DataFrame) -> DataFrame:
    """Add outer_pos and inner_pos: the place of the outer object, found by a join with the owner, and that of an inner one in it, else -1.

    ``entity`` must be a stored table, as it is read twice. Objects deeper than two arrays get the places of the last two.
    """
    owner = entity.select("doc_id", F.col("entity_id").alias("owner_id"), F.col("pos").alias("__owner_pos"))
    inner = F.col("__owner_pos").isNotNull()
    linked = entity.join(owner, ["doc_id", "owner_id"], "left")
    return linked.select(*(F.col(c) for c in entity.columns), F.coalesce("__owner_pos", "pos").alias("outer_pos"), F.when(inner, F.col("pos")).otherwise(-1).alias("inner_pos"))
