"""Ranking of materials, information gain, Bayesian posteriors and Pareto fronts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvinlake.functions import physics
from kelvinlake.functions.constants import EPSILON
from kelvinlake.session import shuffle_partitions, written


def material_rank(df: DataFrame, material="material_id", p="p", zt="zt", citations="c", alpha: float = 1.0, beta: float = 0.1) -> DataFrame:
    """Weighted mean zT less an entropy penalty per material.

    Weights are p * (1 + alpha ln(1 + max(c, 0))); a material whose weights sum to nothing ranks 0. One shuffle, partial sums.
    """
    w = (1 + alpha * F.ln(1 + F.greatest(F.lit(0.0), F.col(citations)))) * F.col(p)
    entropy = F.when(F.col(p) > EPSILON, -F.col(p) * F.ln(F.col(p))).otherwise(0.0)
    sums = df.groupBy(material).agg(F.sum(w).alias("w"), F.sum(w * F.col(zt)).alias("wz"), F.sum(entropy).alias("entropy"))
    relevance = F.when(F.col("w") > EPSILON, F.col("wz") / F.col("w")).otherwise(0.0)
    return sums.select(material, relevance.alias("relevance"), "entropy", (relevance - beta * F.col("entropy")).alias("score"))


def top(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), tie).limit(n)


def information_gain(df: DataFrame, material="material_id", t="t", t_min: float = 300.0, t_max: float = 1200.0, bins: int = 10, gamma1: float = 1.0, gamma2: float = 1.0) -> DataFrame:
    """Entropy of the temperature histogram, its divergence from uniform, and their weighted sum, per material.

    Temperatures outside the range fall into the outer bins. Two levels of aggregation, both combinable on the map side.
    """
    if bins < 1 or t_max <= t_min:
        raise ValueError("need at least one bin and t_max > t_min")
    width = (t_max - t_min) / bins
    index = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(t) - t_min) / width))).cast("int")
    counts = df.filter(physics.finite(F.col(t))).groupBy(material, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # -sum(p ln p) with p = n / N is ln N - sum(n ln n) / N: one pass, no join with the totals.
    sums = counts.groupBy(material).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.ln("n")).alias("nlogn"))
    h = F.ln("total") - F.col("nlogn") / F.col("total")
    d = F.ln(F.lit(float(bins))) - h
    return sums.select(material, F.col("total").alias("n_points"), h.alias("entropy"), d.alias("divergence"), (gamma1 * h + gamma2 * d).alias("gap_score"))


def posterior(df: DataFrame, log_weight: str, out: str = "posterior", by: str | None = None) -> DataFrame:
    """Normalise log weights by log-sum-exp, over everything or per group; null and non-finite weights get no mass.

    The global form uses two one-row aggregates that are broadcast back, not a window over all rows. Rows of which none has mass are an error; no rows give
    no rows.
    """
    w = physics.null_if_not_finite(F.col(log_weight))
    if by is not None:
        group = df.groupBy(by).agg(F.max(w).alias("__m"))
        shifted = df.join(group, by, "left").withColumn("__e", F.coalesce(F.exp(w - F.col("__m")), F.lit(0.0)))
        sums = shifted.groupBy(by).agg(F.sum("__e").alias("__s"))
        return shifted.join(sums, by, "left").withColumns({out: F.try_divide("__e", "__s"), f"log_{out}": w - F.col("__m") - F.ln("__s")}).drop("__m", "__e", "__s")
    peak = df.agg(F.max(w).alias("m")).first()["m"]
    if peak is None:
        if not df.isEmpty():
            raise ValueError("no row has a finite log weight")
        peak, total = 0.0, 1.0
    else:
        total = df.agg(F.sum(F.exp(w - peak)).alias("s")).first()["s"]
    return df.withColumns({out: F.coalesce(F.exp(w - peak), F.lit(0.0)) / total, f"log_{out}": w - peak - F.ln(F.lit(total))})


def pareto_front(df: DataFrame, objectives: tuple[str, str] | list[str], partitions: int | None = None) -> DataFrame:
    """Rows that no other row dominates in two objectives, both to be maximised, without comparing all pairs.

    Rows are reduced to the best second value per distinct first value and swept along range partitions of the first: what a
    row must beat is the best among larger first values, which is the best of later partitions and of the rest of its own.
    Rows with a null objective are never on the front; equal rows are on it together.
    """
    a, b = objectives
    whole = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    n = partitions or shuffle_partitions(df.sparkSession)
    best = whole.groupBy(a).agg(F.max(b).alias("__best")).repartitionByRange(n, a).withColumn("__part", F.spark_partition_id())
    best = written(best, "front")
    later = Window.orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    above = best.groupBy("__part").agg(F.max("__best").alias("m")).withColumn("__above", F.max("m").over(later))
    inside = Window.partitionBy("__part").orderBy(F.desc(a)).rowsBetween(Window.unboundedPreceding, -1)
    swept = best.withColumn("__in", F.max("__best").over(inside)).join(F.broadcast(above.select("__part", "__above")), "__part")
    larger = F.greatest("__in", "__above")
    front = swept.filter(larger.isNull() | (F.col("__best") > larger)).select(a, F.col("__best").alias(b))
    return whole.join(front, [a, b], "left_semi").select(*df.columns)


def log_prior(c: Column) -> Column:
    return F.when(c > 0, F.ln(c))
