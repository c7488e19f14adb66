"""States, cleaning, ranking, statistics and curves on small tables and edge cases."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kelvinlake.operators import clean, curves, rank, states, stats
from kelvinlake.operators.ordered import running_totals

NAN, INF = float("nan"), float("inf")
POINTS = "sample_id int, paper_id int, property_id_y int, x_si double, y_si double"


def test_pivot_states(spark):
    rows = [(1, 1, 2, 304.0, 1e-4), (1, 1, 2, 309.9, 3e-4), (1, 1, 3, 305.0, 100.0), (1, 1, 5, 305.0, 0.02), (1, 1, 5, 305.0, -0.02), (1, 1, 4, 301.0, 2.0), (1, 1, 14, 301.0, 4.0), (1, 1, 15, 300.0, 1e-3), (1, 1, 2, 5.0, 1.0), (1, 1, 2, NAN, 1.0), (1, 1, 2, 300.0, INF), (2, 1, 16, 500.0, 0.7), (None, 1, 2, 300.0, 1e-4), (1, 1, 2, -5.0, 1.0), (1, 1, 2, 1e25, 1.0)]
    out = {(r["sample_id"], r["t_bin_k"]): r for r in states.pivot_states(spark.createDataFrame(rows, POINTS)).collect()}
    a = out[(1, 300.0)]
    assert math.isclose(a["s_si"], 2e-4) and a["sigma_si"] == 75.0 and a["kappa_si"] == 3.0 and math.isclose(a["zt_reported"], 0.3)
    assert out[(2, 500.0)]["zt_reported"] == 0.7 and (None, 300.0) in out and (1, 0.0) not in out
    direct = states.pivot_states(spark.createDataFrame(rows, POINTS), prefer_direct=True).filter("sample_id = 1 AND t_bin_k = 300").first()
    assert direct["sigma_si"] == 100.0
    assert states.state_table(spark.createDataFrame([], POINTS)).count() == 0


def test_group_rows_last_wins(spark):
    df = spark.createDataFrame([("a", 1, 1.0, None, None), ("a", 2, None, 5.0, None), ("a", 3, 2.0, None, 0.5)], "k string, n int, s double, sigma double, rho double")
    r = states.group_rows(df, ["k"], {"s": "s", "sigma": "sigma"}, "n", rho="rho").first()
    assert (r["s"], r["sigma"]) == (2.0, 2.0)


def test_keep_first_and_duplicates(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "a"), (None, 1, "n"), (None, 2, "m"), (2, 9, None)], "k int, o int, e string")
    assert sorted(r["o"] for r in clean.keep_first(df, ["k"], ["o"]).collect()) == [1, 4, 9]
    flagged = {r["o"]: r["dup_flag"] for r in clean.duplicate_flags(df, F.coalesce(F.col("k"), F.lit(0)), ["o"]).collect()}
    assert flagged == {1: 0, 2: 1024, 4: 0, 5: 1024, 9: 0}
    assert {r["dup_flag"] for r in clean.duplicate_flags(df, F.col("k"), ["o"], bypass=True).collect()} == {0}
    new = spark.createDataFrame([(1, 0, "x"), (3, 1, "y"), (3, 0, "z")], df.schema)
    assert sorted(r["e"] or "" for r in clean.insert_or_ignore(df.filter("k = 1"), new, ["k"], ["o"]).collect()) == ["a", "b", "z"]


def test_cross_domain_dedup_large_x(spark):
    row = (1, 1, 1, 2)
    df = spark.createDataFrame([(i, d, f"{d}/f", *row, x) for i, (d, x) in enumerate([("figures", 1.0001), ("samples", 1.0), ("papers", 1.002), ("samples", 1e25), ("samples", 2e25)])], "measurement_id long, source_domain string, source_file string, paper_id int, figure_id int, sample_id int, property_id_y int, x_raw double")
    assert sorted(r[0] for r in clean.cross_domain_dedup(df).select("measurement_id").collect()) == [1, 2, 3, 4]


def test_change_log(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (3, None)], "k int, v string")
    assert {r["k"]: (r["op"], r["previous"]) for r in clean.change_log(old, new, ["k"]).collect()} == {2: ("UPDATE", '{"v":"b"}'), 4: ("INSERT", None)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-50, 50)), min_size=1, max_size=60, unique=True))
def test_running_totals(spark, rows):
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(rows)], "g string, o int, v long")
    got = {(r["g"], r["o"]): r["run_v"] for r in running_totals(df, ["g"], "o", ["v"], partitions=5).collect()}
    assert got == {(g, o): sum(i for i, (h, p) in enumerate(rows) if h == g and p <= o) for g, o in rows}


def test_surrogate_ids(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "o int")
    assert all(r["state_id"] == r["o"] for r in clean.surrogate_ids(df, ["o"]).collect())
    assert clean.surrogate_ids(df.limit(0), ["o"]).count() == 0


def test_information_gain(spark):
    df = spark.createDataFrame([("one", 150.0)] * 4 + [("even", t) for t in (150.0, 250.0, 350.0, 450.0)] + [("out", -9.0), ("out", 9e9)], "m string, t double")
    out = {r["m"]: r for r in rank.information_gain(df, "m", "t", 100.0, 500.0, 4).collect()}
    assert math.isclose(out["one"]["entropy"], 0, abs_tol=1e-12) and math.isclose(out["one"]["divergence"], math.log(4))
    assert math.isclose(out["even"]["entropy"], math.log(4)) and math.isclose(out["out"]["entropy"], math.log(2))
    with pytest.raises(ValueError, match="bin"):
        rank.information_gain(df, "m", "t", bins=0)


def test_posterior(spark):
    df = spark.createDataFrame([("a", -1000.0), ("a", -1001.0), ("b", 5.0), ("b", None), ("c", None)], "g string, w double")
    p = [r["posterior"] for r in rank.posterior(df.filter("g = 'a'"), "w").collect()]
    assert math.isclose(sum(p), 1) and math.isclose(max(p), 1 / (1 + math.exp(-1)))
    by = {(r["g"], r["w"]): r["posterior"] for r in rank.posterior(df, "w", by="g").collect()}
    assert by[("b", 5.0)] == 1.0 and by[("b", None)] == 0.0 and by[("c", None)] is None
    with pytest.raises(ValueError, match="finite"):
        rank.posterior(df.filter("g = 'c'"), "w")


def test_material_rank_handles_zero_weights(spark):
    df = spark.createDataFrame([("a", 0.0, 3.0, -1.0), ("b", 1.0, 2.0, 0.0), ("b", 0.5, 1.0, 3.0)], "material_id string, p double, zt double, c double")
    out = {r["material_id"]: r["score"] for r in rank.material_rank(df).collect()}
    w = 0.5 * (1 + math.log(4))
    assert out["a"] == 0 and math.isclose(out["b"], (2 + w) / (1 + w) + 0.1 * 0.5 * math.log(0.5))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=0, max_size=40))
def test_pareto_front(spark, points):
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "i int, a double, b double")
    beaten = lambda p, q: q[0] >= p[0] and q[1] >= p[1] and q != p
    assert {r["i"] for r in rank.pareto_front(df, ["a", "b"], 3).collect()} == {i for i, p in enumerate(points) if not any(beaten(p, q) for q in points)}


def test_describe_and_ks(spark):
    df = spark.createDataFrame([("x", float(v)) for v in (2, 4, 4, 4, 5, 5, 7, 9)] + [("x", NAN), ("x", INF), ("x", None), ("y", 1.0)], "g string, v double")
    out = {r["g"]: r for r in stats.describe(df, ["g"], "v").collect()}
    assert (out["x"]["n"], out["x"]["mean"], out["x"]["variance"], out["x"]["p50"]) == (8, 5.0, 4.0, 4.5) and out["y"]["sd"] is None
    same = spark.createDataFrame([(b, float(v)) for v in range(100) for b in (True, False)], "f boolean, v double")
    r = stats.ks_two_sample(same, "v", F.col("f")).first()
    assert r["distance"] < 0.01 and r["p_value"] > 0.9 and not r["significant"]
    apart = spark.createDataFrame([(v < 50, float(v)) for v in range(100)], "f boolean, v double")
    r = stats.ks_two_sample(apart, "v", F.col("f")).first()
    assert r["distance"] > 0.9 and r["p_value"] < 0.01 and r["significant"]
    assert stats.ks_two_sample(apart.filter("f"), "v", F.col("f")).first()["distance"] is None


def test_histograms_and_reservoir(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 9.9, 10, 11, -1)] + [(NAN,), (None,)], "v double")
    assert {r["bin"]: r["n"] for r in stats.histogram(df, [], "v", 0.0, 10.0, 10).collect()} == {0: 1, 1: 1, 9: 2}
    big = spark.range(10_000)
    s = stats.reservoir(big, 1000, "id")
    assert s.count() == 1000 and 4000 < s.agg(F.avg("id")).first()[0] < 6000
    assert s.exceptAll(stats.reservoir(big.repartition(7), 1000, "id")).count() == 0 and stats.reservoir(big.limit(0), 5, "id").count() == 0


def test_canonical_hash(spark):
    df = spark.createDataFrame([(1, 0.1, "a"), (2, -0.0, None), (2, NAN, "b")], "i int, v double, s string")
    h = lambda d: stats.canonical_hash(d).first()["digest"]
    assert h(df) == h(df.select("s", "v", "i").orderBy(F.desc("i"))) == h(df.withColumn("v", F.when(F.col("v") == 0, 0.0).otherwise(F.col("v"))))
    assert h(df) != h(df.union(df.limit(1)))


def test_pchip():
    x, y = np.array([0.0, 1.0, 2.0, 4.0]), np.array([0.0, 1.0, 4.0, 4.5])
    assert np.allclose(curves.interpolate(x, y, x), y)
    assert np.allclose(curves.interpolate([0, 1, 2], [1, 3, 5], [0.5, 1.5]), [2, 4])
    assert np.allclose(curves.interpolate([0, 1], [0, 2], [0.25]), [0.5])
    assert curves.pchip_slopes(np.array([0.0, 1, 2]), np.array([0.0, 1, 1]))[0] == 1.0  # the far secant is zero: the near one counts
    dense = curves.interpolate(x, y, np.linspace(0, 4, 200))
    assert np.all(np.diff(dense) >= -1e-12)
    grid, _ = curves.to_grid([200, 400, 600], [1, 2, 3], np.arange(100, 701, 100))
    assert len(grid) == 5
    for bad in (([1.0], [1.0], [1.0]), ([1, 1], [1, 2], [1]), ([2, 1], [1, 2], [1.5]), ([1, 2], [1, 2], [3])):
        with pytest.raises(ValueError, match=r"curve|temperatures|range"):
            curves.interpolate(*bad)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0.1, 10), st.floats(-100, 100)), min_size=2, max_size=12))
def test_pchip_is_monotone(steps):
    x = np.cumsum([s for s, _ in steps])
    y = np.sort([v for _, v in steps])
    dense = curves.interpolate(x, y, np.linspace(x[0], x[-1], 101))
    assert np.all(np.diff(dense) >= -1e-7 * (1 + np.abs(y).max()))


def curve_rows(factor=1.0, t=(300.0, 320.0, 340.0, 360.0), sample=1):
    for x in t:
        s, g, k = 2e-4, 1e5, 1.5
        yield from ((sample, 1, 2, x, s), (sample, 1, 3, x, g), (sample, 1, 4, x, k), (sample, 1, 16, x, s * s * g * x / k * factor))


@pytest.mark.parametrize("check", [curves.crosscheck_linear, curves.crosscheck_pchip])
def test_crosschecks(spark, check):
    rows = [*curve_rows(), *curve_rows(2.0, sample=2), *curve_rows(t=(300.0, 305.0), sample=3), (4, 1, 2, 300.0, 1e-4)]
    out = {r["sample_id"]: r for r in check(spark.createDataFrame(rows, POINTS)).collect()}
    assert out[1]["passed"] and out[1]["mean_error"] < 1e-9 and out[1]["n_grid"] == 7 and out[1]["anomaly_flags"] == 0
    assert not out[2]["passed"] and math.isclose(out[2]["mean_error"], 0.5) and out[2]["anomaly_flags"] == 2
    assert out[3]["anomaly_flags"] == 32 and out[3]["mean_error"] is None and 4 not in out


def test_flag_counts_cover_all_bits(spark):
    df = spark.createDataFrame([(3, 8191), (4, 8191), (1, 0)], "audit_tier int, anomaly_flags int")
    assert Counter(r["n"] for r in stats.flag_frequency(df).collect()) == {1: 13}
    assert [(r["audit_tier"], r["n"]) for r in stats.tier_distribution(df).orderBy("audit_tier").collect()] == [(1, 1), (2, 0), (3, 1), (4, 1)]
