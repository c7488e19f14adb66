"""Entity-attribute-value rows reshaped to one row per entity with typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvinlake.session import bucketed


@dataclass(frozen=True)
class Attribute:
    """A typed output column, filled from the rows whose attribute id is a key of ``sources``.

    ``sources`` maps an attribute id to the SQL expression of its value over the column ``v``; an expression that
    is null leaves the row out. Several ids fill one column as one mean.
    """

    name: str
    sources: tuple[tuple[int, str], ...]
    type: str = "double"


def _balanced(spine: DataFrame, tables: list[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Combine narrow tables by outer joins in a balanced tree.

    Tables and spine are bucketed alike. The lowest joins start from the spine, which has every entity, so that outer
    joins from the left lose none, and a left outer join keeps the partitioning of its left side: no join shuffles.
    """
    if len(tables) <= 2:
        for t in tables:
            spine = spine.join(t, list(keys), "left")
        return spine
    half = (len(tables) + 1) // 2
    return _balanced(spine, tables[:half], keys).join(_balanced(spine, tables[half:], keys), list(keys), "left")


def widen(rows: DataFrame, entity: Sequence[str], attribute: str | Column, value: str | Column, attributes: Sequence[Attribute]) -> DataFrame:
    """One row per entity with a typed column per attribute (the mean of its rows) and its row count ``n_<name>``.

    Null entity columns are a group of their own. Rows with a null or non-finite value, or an attribute id that no column
    asks for, are left out; an entity left with no row at all is absent, an attribute an entity lacks is null.
    Repeated rows count as often as they occur.

    Method: rows are pre-aggregated by (entity, column) in one scan, with map-side partial sums so that a hot
    entity shrinks before the shuffle; the result is written partitioned by attribute column and bucketed by entity, which
    gives co-partitioned, typed narrow tables; these are combined through a balanced tree of outer joins on the entity.
    """
    entity = list(entity)
    attr = F.col(attribute) if isinstance(attribute, str) else attribute
    val = F.col(value) if isinstance(value, str) else value
    inf = float("inf")
    finite = val.isNotNull() & ~F.isnan(val) & (F.abs(val) < inf)
    ids = [i for a in attributes for i, _ in a.sources]
    base = rows.filter(attr.isin(ids) & finite).select(*entity, attr.alias("__id"), val.alias("v"))
    which = [F.when(F.col("__id").isin([i for i, _ in a.sources]), F.lit(a.name)) for a in attributes]
    # An id may feed several columns: one entry each, so the rows are read once.
    values = []
    for a in attributes:
        chosen = F.lit(None).cast("double")
        for i, e in a.sources:
            chosen = F.when(F.col("__id") == i, F.expr(e)).otherwise(chosen)
        values.append(chosen)
    entries = F.array(*(F.struct(w.alias("name"), x.alias("x")) for w, x in zip(which, values, strict=True)))
    long = base.select(*entity, F.explode(entries).alias("__e")).select(*entity, F.col("__e.name").alias("column_name"), F.col("__e.x").alias("__x")).filter(F.col("column_name").isNotNull() & F.col("__x").isNotNull())
    # Joins do not match null keys: nulls travel as a bit set beside stand-in values.
    nulls = F.lit(0)
    for i, k in enumerate(entity):
        nulls = nulls.bitwiseOR(F.when(F.col(k).isNull(), 1 << i).otherwise(0))
    filled = long.select(nulls.alias("__nulls"), *(F.coalesce(F.col(k), F.lit(0).cast(long.schema[k].dataType)).alias(k) for k in entity), "column_name", "__x")
    keys = [*entity, "__nulls"]
    reduced = filled.groupBy(*keys, "column_name").agg(F.avg("__x").alias("__x"), F.count(F.lit(1)).alias("__n"))
    narrow = bucketed(reduced, "narrow", keys, "column_name")
    tables = [
        narrow.filter(F.col("column_name") == a.name).select(*keys, F.col("__x").cast(a.type).alias(a.name), F.col("__n").alias(f"n_{a.name}"))
        for a in attributes
    ]
    wide = _balanced(narrow.select(*keys).distinct(), tables, keys)
    return wide.select(
        *(F.when(F.col("__nulls").bitwiseAND(1 << i) == 0, F.col(k)).alias(k) for i, k in enumerate(entity)),
        *(c for a in attributes for c in (F.col(a.name), F.coalesce(F.col(f"n_{a.name}"), F.lit(0)).alias(f"n_{a.name}"))),
    )
