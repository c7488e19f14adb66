"""Pairing each row with the row of another table that is nearest in time, for the same entity."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kelvinlake.session import shuffle_partitions, written

#: Rows of either table that one Arrow group aims at; a group is held in a Python worker's memory.
GROUP_ROWS = 200_000

_NEAREST = """
SELECT left_id, tm, entity, several, rights_in_at, CASE WHEN backward THEN backward_id ELSE forward_id END AS right_id, CASE WHEN backward THEN backward_at ELSE forward_at END AS right_at
FROM (SELECT b.left_id, b.tm, b.entity, b.several, b.rights_in_at, b.backward_id, b.backward_at, f.right_id AS forward_id, f.tm AS forward_at,
             b.backward_id IS NOT NULL AND b.tm - b.backward_at <= {tolerance} AND (f.right_id IS NULL OR b.tm - b.backward_at <= f.tm - b.tm) AS backward
      FROM (SELECT l.*, r.right_id AS backward_id, r.tm AS backward_at
            FROM l ASOF LEFT JOIN r ON l.{eq} AND l.tm >= r.tm) b
      ASOF LEFT JOIN r f ON b.{eqf} AND b.tm <= f.tm)
WHERE backward OR forward_at - tm <= {tolerance}
"""


def nearest_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    left_id: str,
    right_id: str,
    tolerance: float,
    band: float | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """For each left row the id of the right row of the same entity nearest in time, at most ``tolerance`` away.

    Returns (left_id, right_id); left rows without a partner are absent. Ties go to the earlier right row, then to the lower right
    id. Rows with a null key, time or id, or a time that is not finite, pair with nothing. A left row
    delivered twice is paired twice. Times are numbers.

    Method: rows are hash-partitioned into groups by (entity, time band); right rows also go to the band next to theirs
    if it is within the tolerance, so the nearest candidate is always in the group. Groups of Arrow tables are
    joined in DuckDB by a backward and a forward ASOF join, and the nearer one is selected. Bands spread an
    entity over many groups. A band with more than ``group_rows`` rows on either side is split by a hash of the ids: left
    rows over pieces that each get all right pieces, and if the right side is large too, right rows over pieces whose
    nearest candidates are compared afterwards. So neither side of a group grows with the data.
    """
    spark = left.sparkSession
    width = float(band or 64 * tolerance)
    if width < 2 * tolerance:
        raise ValueError("a band must be at least twice the tolerance wide")
    k = [f"k{i}" for i in range(len(keys))]
    inf = float("inf")

    def usable(df: DataFrame, at: str, row_id: str) -> DataFrame:
        out = df.select(*(F.col(c).cast("long").alias(a) for c, a in zip(keys, k, strict=True)), F.col(at).cast("double").alias("tm"), F.col(row_id).cast("long").alias("id"))
        return out.na.drop().filter(~F.isnan("tm") & (F.abs(F.col("tm")) < inf))

    def band_of(c) -> F.Column:
        return F.floor(c / width).cast("long")

    lefts = usable(left, left_at, left_id).withColumn("band", band_of(F.col("tm"))).withColumn("entity", F.xxhash64(*k))
    rights = usable(right, right_at, right_id).groupBy(*k, "tm").agg(F.min("id").alias("id"))
    rights = rights.withColumn("band", F.explode(F.array_distinct(F.array(band_of(F.col("tm") - tolerance), band_of(F.col("tm") + tolerance)))))

    entity = [*k, "band"]
    sides = lefts.select(*entity, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(rights.select(*entity, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = Observation()
    counts = sides.groupBy(*entity).agg(F.sum("l").alias("l"), F.sum("r").alias("r")).observe(seen, F.sum("l").alias("l"), F.sum("r").alias("r"))
    pieces = [F.greatest(F.ceil(F.col(c) / group_rows), F.lit(1)).cast("int").alias(a) for c, a in (("l", "lefts_in"), ("r", "rights_in"))]
    # The table of large bands is written, so its size is known when the join with it is planned; it is empty as a rule.
    large = written(counts.filter((F.col("l") > group_rows) | (F.col("r") > group_rows)).select(*entity, *pieces), "large-bands")
    total = sum(v or 0 for v in seen.get.values())
    n_groups = max(shuffle_partitions(spark), math.ceil(total / group_rows))
    one = F.lit(1)

    def split(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows with their piece of their own side, once for every piece of the other side."""
        at = F.pmod(F.xxhash64("id", "tm"), F.coalesce(own, one)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1))
        return df.join(large, entity, "left").withColumn(f"{own}_at", at).withColumn(f"{other}_at", copies).withColumn("several", F.coalesce("rights_in", one) > 1).drop("lefts_in", "rights_in")

    group_key = [*entity, "lefts_in_at", "rights_in_at"]
    group = F.pmod(F.xxhash64(*group_key), F.lit(n_groups)).cast("int")
    sql = _NEAREST.format(tolerance=repr(float(tolerance)), eq=" AND l.".join(f"{c} = r.{c}" for c in group_key), eqf=" AND b.".join(f"{c} = f.{c}" for c in group_key))
    schema = pa.schema([("left_id", pa.int64()), ("tm", pa.float64()), ("entity", pa.int64()), ("several", pa.bool_()), ("rights_in_at", pa.int32()), ("right_id", pa.int64()), ("right_at", pa.float64())])

    def pair(l: pa.Table, r: pa.Table) -> pa.Table:  # noqa: E741
        if l.num_rows == 0 or r.num_rows == 0:
            return schema.empty_table()
        import duckdb

        # Without a temporary folder nothing is written beside the shared one.
        with duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""}) as con:
            con.register("l", l)
            con.register("r", r)
            out = con.sql(sql).to_arrow_table()
        return out.cast(schema)

    lg = split(lefts, "lefts_in", "rights_in").withColumnRenamed("id", "left_id").withColumn("grp", group).groupBy("grp")
    rg = split(rights, "rights_in", "lefts_in").drop("several").withColumnRenamed("id", "right_id").withColumn("grp", group).groupBy("grp")
    found = written(lg.cogroup(rg).applyInArrow(pair, "left_id long, tm double, entity long, several boolean, rights_in_at int, right_id long, right_at double"), "nearest")
    # Where right rows are split, a left row has a candidate in each piece, and the nearest counts; copies of a row are counted and given back.
    row = ["left_id", "tm", "entity"]
    each = found.filter("several").groupBy(*row, "rights_in_at").agg(F.min(F.struct(F.abs(F.col("tm") - F.col("right_at")).alias("d"), "right_at", "right_id")).alias("b"), F.count(one).alias("n"))
    best = each.groupBy(*row).agg(F.min("b").alias("b"), F.max("n").cast("int").alias("n"))
    return found.filter("NOT several").select("left_id", "right_id").unionByName(best.select("left_id", F.col("b.right_id").alias("right_id"), F.explode(F.array_repeat(one, F.col("n")))).select("left_id", "right_id"))
