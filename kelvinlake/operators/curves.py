"""Curves over temperature: interpolation, grids, and the zT cross-check of whole curves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvinlake.functions import physics
from kelvinlake.functions.constants import BIT, GRID_STEP, ZT_FLOOR, ZT_TOLERANCE


def check_curve(xs: np.ndarray, ys: np.ndarray) -> None:
    if len(xs) != len(ys) or len(xs) < 2:
        raise ValueError("a curve needs at least two points of equal length")
    if not np.all(np.diff(xs) > 0):
        raise ValueError("temperatures must increase strictly")


def pchip_slopes(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Monotone slopes at the knots.

    Inside, the weighted harmonic mean of the neighbouring secants (0 where they change sign); at the ends a clamped
    one-sided estimate, or the near secant where the far one is zero or of the other sign; then slopes are scaled back, from left to right, where they leave the circle of radius 3.
    """
    h, d = np.diff(xs), np.diff(ys) / np.diff(xs)
    if len(d) == 1:
        return np.array([d[0], d[0]])
    m = np.zeros(len(xs))
    left, right = d[:-1], d[1:]
    w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
    same = left * right > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        m[1:-1] = np.where(same, (w1 + w2) / (w1 / left + w2 / right), 0.0)

    def end(d0: float, d1: float) -> float:
        if d0 * d1 <= 0:
            return d0
        third = (2 * d0 + d1) / 3
        return float(np.clip(third, min(0, 2 * d0), max(0, 2 * d0)))

    m[0], m[-1] = end(d[0], d[1]), end(d[-1], d[-2])
    for i, secant in enumerate(d):
        if secant == 0:
            m[i] = m[i + 1] = 0.0
            continue
        r = np.hypot(m[i] / secant, m[i + 1] / secant)
        if r > 3:
            m[i], m[i + 1] = 3 * m[i] / r, 3 * m[i + 1] / r
    return m


def interpolate(xs, ys, at, method: str = "pchip") -> np.ndarray:
    """Values at points inside the range of the curve; a point outside is an error."""
    xs, ys, at = (np.asarray(v, dtype=float) for v in (xs, ys, at))
    check_curve(xs, ys)
    if len(at) and (at.min() < xs[0] or at.max() > xs[-1]):
        raise ValueError("outside the range of the curve")
    if method == "linear":
        return np.interp(at, xs, ys)
    i = np.clip(np.searchsorted(xs, at, side="right") - 1, 0, len(xs) - 2)
    h = xs[i + 1] - xs[i]
    u = (at - xs[i]) / h
    m = pchip_slopes(xs, ys)
    rise = ys[i + 1] - ys[i]
    # Cubic in u: start value, start slope, and the two corrections that meet end value and end slope.
    a, b = m[i] * h, m[i + 1] * h
    return ys[i] + u * (a + u * ((3 * rise - 2 * a - b) + u * (a + b - 2 * rise)))


def to_grid(xs, ys, grid, method: str = "pchip") -> tuple[np.ndarray, np.ndarray]:
    """The grid points inside the range, and the values there; other grid points are dropped."""
    grid = np.asarray(grid, dtype=float)
    kept = grid[(grid >= min(xs)) & (grid <= max(xs))]
    return kept, interpolate(xs, ys, kept, method) if len(kept) else kept


ROLES = ("s", "sigma", "kappa", "zt")
CHECK_SCHEMA = "sample_id int, paper_id int, n_grid int, mean_error double, max_error double, passed boolean, anomaly_flags int"


def curve_points(points: DataFrame, sample="sample_id", paper="paper_id", prop="property_id_y", x="x_si", y="y_si") -> DataFrame:
    """One mean value per (sample, paper, role, temperature) of the four curves; bounds a group to distinct temperatures."""
    role = F.when(F.col(prop) == 2, "s").when(F.col(prop) == 3, "sigma").when(F.col(prop) == 4, "kappa").when(F.col(prop) == 16, "zt")
    good = points.filter((F.col(x) > 0) & physics.finite(F.col(x)) & physics.finite(F.col(y))).withColumn("role", role).filter("role IS NOT NULL")
    return good.groupBy(F.col(sample).alias("sample_id"), F.col(paper).alias("paper_id"), "role", F.col(x).alias("t")).agg(F.avg(y).alias("y"))


def _compare(ts: np.ndarray, s, sigma, kappa, reported) -> tuple[float, float]:
    with np.errstate(divide="ignore", invalid="ignore"):
        computed = np.where(kappa != 0, s * s * sigma * ts / kappa, np.nan)
    error = np.abs(computed - reported) / np.maximum(np.abs(reported), ZT_FLOOR)
    known = error[~np.isnan(error)]
    return float(known.sum() / len(ts)), float(known.max()) if len(known) else float("nan")


def crosscheck_pchip(points: DataFrame, min_overlap: int = 3, step: float = GRID_STEP) -> DataFrame:
    """Compare reported with computed zT on a grid over the common range of the four curves of a sample.

    Curves are interpolated monotonically, whose slope scaling is sequential and hence runs in Python over Arrow batches of
    whole curves, after a reduction to distinct temperatures. Too few grid points give a row with nulls and
    the flag for insufficient interpolation; samples without all four curves give none.
    """

    def check(curve: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple:
        low, high = max(t[0] for t, _ in curve.values()), min(t[-1] for t, _ in curve.values())
        n = int(np.floor((high - low) / step)) + 1 if high >= low else 0
        if n < min_overlap:
            return n, None, None, False, BIT["INTERP_INSUFFICIENT"]
        grid = np.minimum(low + step * np.arange(n), high)
        mean, largest = _compare(grid, *(interpolate(*curve[r], grid) for r in ROLES))
        good = mean <= ZT_TOLERANCE
        return n, mean, largest, good, 0 if good else BIT["ZT_CROSSCHECK_FAIL"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.int32()]
        for batch in batches:
            lists = {r: batch.column(r) for r in ROLES}
            points = {r: (c.values.field("t").to_numpy(zero_copy_only=False), c.values.field("y").to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for r, c in lists.items()}
            rows = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                curve = {r: (t[o[i] : o[i + 1]], y[o[i] : o[i + 1]]) for r, (t, y, o) in points.items()}
                rows.append((*key, *check(curve)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in CHECK_SCHEMA.split(", ")])

    of = lambda r: F.array_sort(F.collect_list(F.when(F.col("role") == r, F.struct("t", "y")))).alias(r)
    curves = curve_points(points).groupBy("sample_id", "paper_id").agg(*(of(r) for r in ROLES)).filter(" AND ".join(f"size({r}) >= 2" for r in ROLES))
    return curves.mapInArrow(run, CHECK_SCHEMA)


def crosscheck_linear(points: DataFrame, min_overlap: int = 3, step: float = GRID_STEP) -> DataFrame:
    """The cross-check with linear interpolation, as joins and windows only.

    Grid points are made per sample from the common range; each is placed on the segment of each curve that holds it by its
    position among the knots: knots and grid points are merged and the neighbours are taken by a window, so there is no range join.
    """
    knots = curve_points(points)
    span = knots.groupBy("sample_id", "paper_id", "role").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count(F.lit(1)).alias("n"))
    common = span.filter("n >= 2").groupBy("sample_id", "paper_id").agg(F.max("a").alias("low"), F.min("b").alias("high"), F.count(F.lit(1)).alias("n_curves")).filter(F.col("n_curves") == len(ROLES))
    n_grid = F.when(F.col("high") >= F.col("low"), F.floor((F.col("high") - F.col("low")) / step) + 1).otherwise(0)
    common = common.withColumn("n_grid", n_grid.cast("int"))
    grid = common.filter(F.col("n_grid") >= min_overlap).select("sample_id", "paper_id", "low", F.explode(F.sequence(F.lit(0), F.col("n_grid") - 1)).alias("i"))
    grid = grid.select("sample_id", "paper_id", "i", (F.col("low") + F.col("i") * F.lit(float(step))).alias("t"), F.explode(F.array(*(F.lit(r) for r in ROLES))).alias("role"))
    both = knots.select("sample_id", "paper_id", "role", "t", "y", F.lit(None).cast("int").alias("i")).unionByName(grid.select("sample_id", "paper_id", "role", "t", F.lit(None).cast("double").alias("y"), "i"))
    w = Window.partitionBy("sample_id", "paper_id", "role").orderBy("t", F.col("i").isNotNull())
    knot = F.when(F.col("i").isNull(), F.struct("t", "y"))
    back = F.last(knot, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(knot, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    placed = both.withColumns({"p": back, "q": ahead}).filter("i IS NOT NULL")
    share = (F.col("t") - F.col("p.t")) / (F.col("q.t") - F.col("p.t"))
    value = F.when(F.col("q").isNull() | (F.col("p.t") == F.col("t")), F.col("p.y")).otherwise(F.col("p.y") + (F.col("q.y") - F.col("p.y")) * share)
    wide = placed.withColumn("v", value).groupBy("sample_id", "paper_id", "i", "t").agg(*(F.max(F.when(F.col("role") == r, F.col("v"))).alias(r) for r in ROLES))
    computed = F.when(F.col("kappa") != 0, physics.zt(F.col("s"), F.col("sigma"), F.col("kappa"), F.col("t")))
    error = F.abs(computed - F.col("zt")) / F.greatest(F.abs(F.col("zt")), F.lit(ZT_FLOOR))
    out = wide.withColumn("e", error).groupBy("sample_id", "paper_id").agg(F.count(F.lit(1)).cast("int").alias("n_grid"), (F.sum("e") / F.count(F.lit(1))).alias("mean_error"), F.max("e").alias("max_error"))
    out = out.withColumn("passed", F.coalesce(F.col("mean_error") <= ZT_TOLERANCE, F.lit(False)))
    out = out.withColumn("anomaly_flags", F.when(F.col("passed"), 0).otherwise(BIT["ZT_CROSSCHECK_FAIL"]).cast("int"))
    short = common.filter(F.col("n_grid") < min_overlap).select(
        "sample_id", "paper_id", "n_grid", F.lit(None).cast("double").alias("mean_error"), F.lit(None).cast("double").alias("max_error"), F.lit(False).alias("passed"), F.lit(BIT["INTERP_INSUFFICIENT"]).alias("anomaly_flags")
    )
    return out.unionByName(short)
