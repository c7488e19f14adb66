"""Distribution statistics: descriptions, quantiles, two-sample tests, histograms, correlations, counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics
from kelvinlake.operators.ordered import running_totals

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def describe(df: DataFrame, by: Sequence[str], value: str, exact: bool = True) -> DataFrame:
    """Count, mean, sample and population deviation, least, five quantiles, largest; NaN, infinite and null left out.

    ``exact`` quantiles interpolate linearly; without it they are approximate sketches that merge on the map side and
    stay bounded for a hot group.
    """
    v = F.col(value)
    good = df.filter(physics.finite(v))
    quantile = (lambda q: F.percentile(v, F.lit(q))) if exact else (lambda q: F.percentile_approx(v, F.lit(q), F.lit(10_000)))
    return good.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.var_pop(v).alias("variance"), F.min(v).alias("least"),
        *(quantile(q).alias(f"p{round(q * 100):02d}") for q in QUANTILES), F.max(v).alias("largest"),
    )


def ks_two_sample(df: DataFrame, value: str, is_first: Column, by: Sequence[str] = ()) -> DataFrame:
    """Kolmogorov-Smirnov distance of two samples in one table, with p-value, per group.

    The largest gap of the two distribution functions is found over distinct values: rows are first reduced to counts
    per value, which combine on the map side, and cumulated over range partitions (see ``ordered.running_totals``).
    An empty side gives nulls.
    """
    first = is_first.cast("int")
    keys = list(by)
    per = df.filter(physics.finite(F.col(value))).groupBy(*keys, F.col(value).alias("__v")).agg(F.sum(first).alias("a"), F.sum(1 - first).alias("b"))
    run = running_totals(per, keys, "__v", ["a", "b"])
    sizes = run.groupBy(*keys).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    if keys:
        cumulated = run.join(sizes, keys)
    else:  # one row of totals, as constants
        one = sizes.first()
        cumulated = run.withColumns({"na": F.lit(one["na"]).cast("long"), "nb": F.lit(one["nb"]).cast("long")})
    gap = F.abs(F.try_divide(F.col("run_a"), F.col("na")) - F.try_divide(F.col("run_b"), F.col("nb")))
    out = cumulated.groupBy(*keys).agg(F.max("na").alias("n1"), F.max("nb").alias("n2"), F.max(gap).alias("distance"))
    lam = F.col("distance") * F.sqrt(F.try_divide(F.col("n1").cast("double") * F.col("n2"), F.col("n1") + F.col("n2")))
    return out.withColumn("p_value", F.when(F.col("distance").isNotNull(), physics.kolmogorov_p(lam))).withColumn("significant", F.col("p_value") < 0.05)


def tier_distribution(states: DataFrame) -> DataFrame:
    """Count and percentage of every tier 1..4, tiers without states included."""
    counts = states.groupBy("audit_tier").agg(F.count(F.lit(1)).alias("n"))
    tiers = states.sparkSession.range(1, 5).select(F.col("id").cast("int").alias("audit_tier"))
    total = F.sum("n").over(Window.partitionBy())
    out = tiers.join(counts, "audit_tier", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.select("audit_tier", "n", F.coalesce(F.try_divide(100.0 * F.col("n"), total), F.lit(0.0)).alias("percent"))


def flag_frequency(states: DataFrame, max_tier: int = 3) -> DataFrame:
    """How many states up to a tier carry each flag, flags without states included; one pass with a counter per bit."""
    counted = states.filter(F.col("audit_tier") <= max_tier).agg(*(F.count_if(physics.has_flag(F.col("anomaly_flags"), n)).alias(n) for n in K.FLAGS))
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("bit"), F.lit(n).alias("flag"), F.col(n).alias("n")) for i, n in enumerate(K.FLAGS))))
    return counted.select(pairs.alias("r")).select("r.*")


def funnel(states: DataFrame) -> DataFrame:
    """From all states to usable ones: has S, sigma, kappa; complete; tier A; 0 <= zT <= 4."""
    has = [F.col(c).isNotNull() for c in ("s_si", "sigma_si", "kappa_si")]
    complete = physics.all_of(*has)
    return states.agg(
        F.count(F.lit(1)).alias("n_states"), F.count_if(has[0]).alias("n_s"), F.count_if(has[1]).alias("n_sigma"), F.count_if(has[2]).alias("n_kappa"),
        F.count_if(complete).alias("n_complete"), F.count_if(F.col("audit_tier") == 1).alias("n_tier_a"), F.count_if(F.col("zt_computed").between(0, 4)).alias("n_zt_ok"),
    )


def pipeline_counters(states: DataFrame) -> DataFrame:
    """Counters of the audit, in one aggregate."""
    f = F.col("anomaly_flags")
    hard = {n: F.count_if(physics.has_flag(f, n)).alias(c) for n, c in (("ALGEBRAIC_REJECT", "n_algebraic"), ("SEEBECK_BOUND_EXCEED", "n_seebeck_bound"), ("SIGMA_BOUND_EXCEED", "n_sigma_bound"), ("KAPPA_BOUND_EXCEED", "n_kappa_bound"))}
    soft = {n: F.count_if(physics.has_flag(f, n)).alias(c) for n, c in (("WF_VIOLATION", "n_wf"), ("ZT_CROSSCHECK_FAIL", "n_crosscheck"), ("TEMPERATURE_OUT_OF_RANGE", "n_temperature"))}
    out = states.agg(F.count(F.lit(1)).alias("n_total"), *hard.values(), *soft.values(), F.count_if(F.col("audit_tier") == 4).alias("n_rejected"))
    return out.withColumn("rejection_rate", F.coalesce(F.try_divide(F.col("n_rejected").cast("double"), F.col("n_total")), F.lit(0.0)))


def audit_telemetry(states: DataFrame, zt: str = "zt_computed") -> DataFrame:
    """The summary of an audit, in one aggregate: states, tiers A and rejected in percent, and zT of tiers A and B: count, mean, median, largest, population deviation, 95th percentile."""
    good = F.when(F.col("audit_tier").isin(1, 2) & physics.finite(F.col(zt)), F.col(zt))
    share = lambda t: F.coalesce(F.try_divide(100.0 * F.count_if(F.col("audit_tier") == t), F.count(F.lit(1))), F.lit(0.0))
    return states.agg(
        F.count(F.lit(1)).alias("n_states"), share(1).alias("pct_tier_a"), share(4).alias("pct_rejected"), F.count(good).alias("n_zt"), F.avg(good).alias("mean_zt"),
        F.percentile(good, F.lit(0.5)).alias("median_zt"), F.max(good).alias("max_zt"), F.stddev_pop(good).alias("sd_zt"), F.percentile(good, F.lit(0.95)).alias("p95_zt"),
    )


def certificate(states: DataFrame, paper: str = "paper_id", sample: str = "sample_id", zt: str = "zt_computed") -> DataFrame:
    """What a release certifies of its usable states (tiers 1 to 3): distinct papers and samples, states, and zT: mean, sample deviation, least, median, largest."""
    usable = states.filter(F.col("audit_tier").between(1, 3))
    z = F.when(physics.finite(F.col(zt)), F.col(zt))
    return usable.agg(
        F.count(F.lit(1)).alias("n_states"), F.count_distinct(paper).alias("n_papers"), F.count_distinct(F.struct(paper, sample)).alias("n_samples"),
        F.avg(z).alias("mean_zt"), F.stddev_samp(z).alias("sd_zt"), F.min(z).alias("least_zt"), F.percentile(z, F.lit(0.5)).alias("median_zt"), F.max(z).alias("largest_zt"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all pairs on complete rows, long form, from one aggregate."""
    rows = df.filter(physics.all_of(*(physics.finite(F.col(c)) for c in columns)))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = rows.agg(F.count(F.lit(1)).alias("n"), *(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    entries = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs))
    return one.select("n", F.explode(entries).alias("e")).select("e.a", "e.b", "n", "e.r")


def describe_by_tier(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Description of several columns per tier: unpivoted once, grouped once."""
    long = states.select("audit_tier", F.explode(F.array(*(F.struct(F.lit(c).alias("property"), F.col(c).cast("double").alias("v")) for c in columns))).alias("e")).select("audit_tier", "e.*")
    return describe(long, ["audit_tier", "property"], "v")


def histogram(df: DataFrame, by: Sequence[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts per bin of equal width; values outside the range are left out, the upper edge belongs to the last bin."""
    v = F.col(value)
    index = F.least(F.floor((v - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return df.filter((v >= low) & (v <= high)).groupBy(*by, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram2d(df: DataFrame, x: str, y: str, x_range: tuple, y_range: tuple, bins: int) -> DataFrame:
    cell = lambda c, r: F.least(F.floor((F.col(c) - r[0]) / ((r[1] - r[0]) / bins)), F.lit(bins - 1)).cast("int")
    inside = F.col(x).between(*x_range) & F.col(y).between(*y_range)
    return df.filter(inside).groupBy(cell(x, x_range).alias("x_bin"), cell(y, y_range).alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def reservoir(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A uniform sample of fixed size: the n rows whose hashed keys are least; a top-k that never sorts everything.

    The same rows come out however the table is partitioned and whatever tasks run again. ``key`` should be unique; rows with
    equal keys are taken or left together but for the last place. A null key counts as a key of its own.
    """
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return df.orderBy(order, key).limit(n)


def canonical_hash(df: DataFrame) -> DataFrame:
    """One digest of a table whatever its row order: SHA-256 per row over sorted columns, combined by count and sums.

    Floats are written with 12 decimals, -0 as 0, NaN and infinities as text, null as 'null'.
    """
    def canonical(f) -> Column:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            body = F.when(F.isnan(c), "NaN").when(c == float("inf"), "Infinity").when(c == float("-inf"), "-Infinity").otherwise(F.format_string("%.12f", c + F.lit(0.0)))
        else:
            body = c.cast("string")
        return F.concat(F.lit(f.name + "="), F.coalesce(body, F.lit("null")))

    row = F.sha2(F.concat_ws("\u001f", *(canonical(f) for f in sorted(df.schema.fields, key=lambda f: f.name))), 256)
    part = lambda i: F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).alias(f"s{i}")
    return df.select(row.alias("h")).agg(F.count(F.lit(1)).alias("n_rows"), *(part(i) for i in range(8))).select("n_rows", F.sha2(F.concat_ws("|", "n_rows", *(f"s{i}" for i in range(8))), 256).alias("digest"))
