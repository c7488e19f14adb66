"""Pivoting points into thermoelectric states, and the audited state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvinlake.functions import physics
from kelvinlake.functions.constants import T_BIN


def _of(prop: Column, value: Column, *ids: int) -> Column:
    return F.when(prop.isin(*ids), value)


def pivot_states(points: DataFrame, sample="sample_id", paper="paper_id", prop="property_id_y", x="x_si", y="y_si", width: float = T_BIN, prefer_direct: bool = False) -> DataFrame:
    """One row per (sample, paper, temperature bin) with mean S, sigma, kappa, rho and reported zT.

    Bins are floors; points at x <= 0 and bins at 0 are left out. Sigma averages direct values with 1/rho of positive rho,
    kappa total with lattice values, zT reported zT with Z*T; ``prefer_direct`` uses 1/rho only in bins without a
    direct value. A single shuffle with map-side partial sums: a hot sample shrinks before it moves. Values that are null,
    NaN or infinite are left out of the means.
    """
    p, v = F.col(prop), F.col(y)
    good = points.filter((F.col(x) > 0) & physics.finite(F.col(x)) & physics.finite(v))
    binned = good.withColumn("t_bin_k", F.floor(F.col(x) / width) * float(width)).filter("t_bin_k > 0")
    inverse = lambda i: F.when((p == i) & (v > 0), 1 / v)
    direct, derived = F.avg(_of(p, v, 3)), F.avg(inverse(5))
    mixed = F.avg(F.when(p == 3, v).when((p == 5) & (v > 0), 1 / v))
    return binned.groupBy(F.col(sample).alias("sample_id"), F.col(paper).alias("paper_id"), "t_bin_k").agg(
        F.avg(_of(p, v, 2)).alias("s_si"),
        (F.coalesce(direct, derived) if prefer_direct else mixed).alias("sigma_si"),
        F.avg(_of(p, v, 4, 14)).alias("kappa_si"),
        F.avg(F.when(p == 5, v).when((p == 3) & (v > 0), 1 / v)).alias("rho_si"),
        F.avg(F.when(p == 16, v).when(p == 15, v * F.col(x))).alias("zt_reported"),
        F.count(F.lit(1)).alias("n_points"),
    )


def pivot_rounded(points: DataFrame, sample="sample_id", prop="property_id_y", x="x_si", y="y_si", width: float = T_BIN) -> DataFrame:
    """The rounded variant: bins by half-even rounding, means per property, sigma from 1/rho only where it is missing."""
    roles = {2: "s", 3: "sigma", 4: "kappa", 5: "rho", 16: "zt"}
    good = points.filter(F.col(prop).isin(*roles) & physics.finite(F.col(x)) & physics.finite(F.col(y)))
    binned = good.withColumn("t_round_k", F.rint(F.col(x) / width) * float(width))
    wide = binned.groupBy(F.col(sample).alias("sample_id"), "t_round_k").pivot(prop, list(roles)).agg(F.avg(y))
    wide = wide.withColumnsRenamed({str(k): v for k, v in roles.items()})
    return wide.withColumn("sigma", F.coalesce("sigma", F.when(F.col("rho") > 1e-12, 1 / F.col("rho"))))


def state_table(points: DataFrame, **kw) -> DataFrame:
    """Pivot and audit in one plan; incomplete states have tier 4 and flags 0."""
    return physics.audit(pivot_states(points, **kw), "s_si", "sigma_si", "kappa_si", "t_bin_k", incomplete_flags=0)


def clean_states(states: DataFrame, tiers=(1, 2)) -> DataFrame:
    """States of the clean tiers: A and B, or as asked for."""
    return states.filter(F.col("audit_tier").isin(*tiers))


def group_rows(rows: DataFrame, keys: list[str], roles: dict[str, str], order: str, rho: str | None = None) -> DataFrame:
    """Grouping of table rows into states: per role the last non-null value in row order wins.

    ``roles`` maps output names to columns; with ``rho``, sigma falls back to 1/rho on rows without sigma and with rho > 1e-12.
    """
    out = rows
    if rho is not None:
        sigma = roles["sigma"]
        out = out.withColumn(sigma, F.coalesce(F.col(sigma), F.when(F.col(rho) > 1e-12, 1 / F.col(rho))))
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
    return out.groupBy(*keys).agg(*(last(c).alias(name) for name, c in roles.items()))


def csv_report(states: DataFrame, s="s", sigma="sigma", kappa="kappa", t="t") -> DataFrame:
    """Report of table states: how many are complete, rejected and valid, and mean, least and largest zT.

    Bounds of this operator are its own: |S| <= 0.05, sigma <= 1e8, kappa <= 5000, 0 <= zT <= 5.
    """
    cs, cg, ck, ct = (F.col(c) for c in (s, sigma, kappa, t))
    complete = physics.all_of(cs.isNotNull(), cg.isNotNull(), ck.isNotNull(), ct.isNotNull())
    ok = complete & (ct > 0) & (ck > 0) & (cg > 0) & (F.abs(cs) <= 0.05) & (cg <= 1e8) & (ck <= 5000)
    value = F.when(ok, physics.zt(cs, cg, ck, ct.cast("double")))
    good = F.when((value >= 0) & (value <= 5), value)
    return states.select(complete.alias("complete"), good.alias("zt")).agg(
        F.count(F.lit(1)).alias("n_states"), F.count_if("complete").alias("n_complete"), F.count("zt").alias("n_valid"), (F.count_if("complete") - F.count("zt")).alias("n_rejected"),
        F.avg("zt").alias("mean_zt"), F.min("zt").alias("min_zt"), F.max("zt").alias("max_zt"),
    )
