"""Filters, reference checks, deduplication and change detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics, text


def finite_points(points: DataFrame, x="x_si", y="y_si") -> DataFrame:
    return points.filter(physics.finite(F.col(x)) & physics.finite(F.col(y)))


def allowed_points(points: DataFrame, prop="property_id_y", allowed: Sequence[int] = K.ALLOWED_PROPERTIES) -> DataFrame:
    return points.filter(F.col(prop).isin(*allowed))


def ingest_counters(points: DataFrame, prop="property_id_y", x="x_si", y="y_si") -> DataFrame:
    """Points seen, kept and rejected: not finite and not allowed share one counter, as the filters are one step."""
    good = physics.finite(F.col(x)) & physics.finite(F.col(y)) & F.col(prop).isin(*K.ALLOWED_PROPERTIES)
    kept = F.coalesce(good, F.lit(False))
    return points.groupBy(prop).agg(F.count(F.lit(1)).alias("n_points"), F.count_if(kept).alias("n_kept"), F.count_if(~kept).alias("n_rejected"))


def policy_violations(points: DataFrame, prop="property_id_y", y="y_si") -> DataFrame:
    """Points outside the bounds of their property, per property and side."""
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for i, (a, b) in K.POLICY_BOUNDS.items():
        low, high = F.when(F.col(prop) == i, a).otherwise(low), F.when(F.col(prop) == i, b).otherwise(high)
    v = F.col(y)
    side = F.when(v < low, "below").when(v > high, "above")
    return points.filter(physics.finite(v)).select(prop, side.alias("side")).filter("side IS NOT NULL").groupBy(prop, "side").agg(F.count(F.lit(1)).alias("n_points"))


def figure_mismatch(points: DataFrame, figures: DataFrame, keys: Sequence[str] = ("figure_id", "paper_id")) -> DataFrame:
    """Points with flag bit 9 where their figure is not listed; every point is kept.

    Figures are reduced to distinct keys, so a repeated figure does not multiply points.
    """
    known = figures.select(*keys).distinct().withColumn("__known", F.lit(True))
    out = points.join(known, list(keys), "left")
    return out.withColumn("anomaly_flags", F.when(F.col("__known").isNull(), K.BIT["FIGUREID_MISMATCH"]).otherwise(0)).drop("__known")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key in a total order: deterministic, unlike dropDuplicates. Null keys are keys.

    An aggregate with map-side combine picks the first row of each key (least order values), so that a hot key is
    not gathered in one task.
    """
    names = df.columns
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    return df.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.min_by(row, F.struct(*sort)).alias("__row")).select("__row.*")


def domain_priority(domain: Column) -> Column:
    out = F.lit(9)
    for name, p in K.DOMAIN_PRIORITY.items():
        out = F.when(domain == name, p).otherwise(out)
    return out


def cross_domain_dedup(points: DataFrame, order: Sequence[str] = ("source_file", "measurement_id")) -> DataFrame:
    """One row per (paper, figure, sample, property, x to 3 decimals): the best domain first, then the order given.

    Rounding stays in doubles: whole numbers would run over for the large x of axes that are not temperature.
    """
    keyed = points.withColumn("__x3", F.rint(F.col("x_raw") * 1e3))
    out = keep_first(keyed, ["paper_id", "figure_id", "sample_id", "property_id_y", "__x3"], [domain_priority(F.col("source_domain")), *order])
    return out.drop("__x3")


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Existing rows, and of the incoming ones the first per key whose key is not there yet."""
    fresh = keep_first(incoming, keys, order).join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.unionByName(fresh)


def duplicate_flags(rows: DataFrame, key: Column, order: Sequence[str], bypass: bool = False) -> DataFrame:
    """Rows with ``dup_flag``: bit 10 on every row but the first of its key; 0 everywhere with ``bypass``.

    The first row of a key comes from an aggregate and is found again by its unique order values, so the hot key is not
    sorted in one task.
    """
    if bypass:
        return rows.withColumn("dup_flag", F.lit(0))
    keyed = rows.withColumn("__key", key)
    firsts = keyed.groupBy("__key").agg(F.min(F.struct(*order)).alias("f")).select("f.*").withColumn("__first", F.lit(True))
    out = keyed.join(firsts, list(order), "left")
    return out.withColumn("dup_flag", F.when(F.col("__first"), 0).otherwise(K.BIT["DUPLICATE_SUSPECTED"])).drop("__key", "__first")


def experiment_filter(samples: DataFrame, fields: Sequence[str], allowed: Sequence[str] = ("Experimental",)) -> DataFrame:
    return samples.withColumn("experiment_class", text.experiment_class([F.col(f) for f in fields])).filter(F.col("experiment_class").isin(*allowed))


def constraint_violations(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """(key, rule) for every row and rule that does not hold; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items())))
    return df.select(key, F.explode(broken).alias("rule"))


def change_log(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two snapshots with unique keys, with the previous state as JSON."""
    values = [c for c in new.columns if c not in keys]
    pack = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    both = pack(old, "__old").join(pack(new, "__new"), list(keys), "full_outer")
    op = F.when(F.col("__old").isNull(), "INSERT").when(F.col("__new").isNull(), "DELETE").when(~F.col("__old").eqNullSafe(F.col("__new")), "UPDATE")
    return both.select(*keys, op.alias("op"), F.to_json("__old").alias("previous")).filter("op IS NOT NULL")


def surrogate_ids(df: DataFrame, order: Sequence[str], name: str = "state_id") -> DataFrame:
    """0, 1, 2, ... in a total order, without sorting everything in one task.

    Rows are range-partitioned and sorted; the offset of each partition comes from the counts of the partitions before it.
    """
    from kelvinlake.session import shuffle_partitions, written

    n = shuffle_partitions(df.sparkSession)
    ranged = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = ranged.join(F.broadcast(offsets.select("__part", "first", "__offset")), "__part")
    return out.withColumn(name, F.col("__offset") + F.col("__at") - F.col("first")).drop("__part", "__at", "first", "__offset")


def named_properties(properties: DataFrame, name: str, roles: Mapping[str, str]) -> DataFrame:
    """The properties whose name is exactly one of ``roles``, with the role of each; a null name is none."""
    role = F.create_map(*(F.lit(x) for pair in roles.items() for x in pair))[F.col(name)]
    return properties.filter(F.col(name).isin(*roles)).withColumn("role", role)
