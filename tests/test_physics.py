"""Exact vectors of the row functions."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics, quality, text, units

STATE = "s double, sigma double, kappa double, t double, zt_reported double"
NAN, INF = float("nan"), float("inf")


def audit(spark, *rows):
    return physics.audit(spark.createDataFrame(list(rows), STATE)).collect()


def test_audit_branches(spark):
    z = 200e-6**2 * 1e5 * 300 / 1.5
    out = audit(
        spark, (200e-6, 1e5, 1.5, 300.0, z), (200e-6, 1e5, 1.5, 300.0, 1.25 * z), (10e-6, 1e7, 0.01, 300.0, None), (50e-3, 1e5, 1.5, 300.0, None), (2e-4, 2e7, 1.5, 300.0, None),
        (2e-4, 1e5, 500.0, 300.0, None), (200e-6, 1e5, 0.3, 50.0, None), (200e-6, 1e5, 10.0, 2500.0, None), (1e-3, 1e5, 1.5, 300.0, NAN),
    )
    assert [(r["audit_tier"], r["anomaly_flags"]) for r in out] == [(1, 0), (3, 2), (3, 1), (4, 64 + 2048), (4, 128 + 2048), (4, 256 + 2048), (3, 4096), (3, 4096), (1, 0)]
    assert math.isclose(out[1]["zt_error"], 0.2, rel_tol=1e-12) and out[3]["zt_computed"] is None and out[8]["zt_error"] is None


@pytest.mark.parametrize("bad", [NAN, INF, -INF, None])
def test_singular_states_are_rejected(spark, bad):
    base = [2e-4, 1e5, 1.5, 300.0]
    rows = [tuple(bad if i == j else v for j, v in enumerate(base)) + (None,) for i in range(4)]
    rows += [(2e-4, v, 1.5, 300.0, None) for v in (0.0, -1.0)] + [(2e-4, 1e5, v, 300.0, None) for v in (0.0, -1.2)] + [(2e-4, 1e5, 1.5, v, None) for v in (0.0, -50.0)]
    assert {(r["audit_tier"], r["anomaly_flags"], r["zt_computed"]) for r in audit(spark, *rows)} == {(4, 2048, None)}


def test_incomplete_states_keep_flags_zero(spark):
    df = spark.createDataFrame([(None, 1e5, 1.5, 300.0, None), (2e-4, -1.0, 1.5, 300.0, None)], STATE)
    assert [(r["audit_tier"], r["anomaly_flags"]) for r in physics.audit(df, incomplete_flags=0).collect()] == [(4, 0), (4, 2048)]


def test_zt_batch_bounds(spark):
    rows = [(0.05, 1e5, 1.5, 300.0), (2e-4, 1e8, 1.5, 300.0), (2e-4, 1e5, 5000.0, 300.0), (2e-4, 1e5, 1.5, -50.0), (2e-4, 1e5, 1.5, 300.0), (None, 1e5, 1.5, 300.0)]
    df = spark.createDataFrame(rows, "s double, sigma double, kappa double, t double")
    out = [r[0] for r in df.select(physics.zt_batch(*(F.col(c) for c in df.columns))).collect()]
    assert out[:4] == [None] * 4 and math.isclose(out[4], 0.8) and out[5] is None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.sampled_from([NAN, INF, 0.0, -1.0]), st.floats(1e-6, 1e4))] * 5), min_size=1, max_size=30))
def test_tier_and_flags_agree(spark, rows):
    for r in audit(spark, *rows):
        rejected = r["audit_tier"] == 4
        assert rejected == bool(r["anomaly_flags"] & 2048) == (r["zt_computed"] is None)
        assert rejected or (r["audit_tier"] == 1) == (r["anomaly_flags"] == 0) or r["audit_tier"] in (2, 3)


def test_decode_flags(spark):
    out = spark.createDataFrame([(0,), (8191,), (66,)], "f int").select(physics.decode_flags(F.col("f"))).collect()
    assert [r[0] for r in out] == [[], list(K.FLAGS), ["ZT_CROSSCHECK_FAIL", "SEEBECK_BOUND_EXCEED"]]


def test_propagation_and_decomposition(spark):
    df = spark.createDataFrame([(2e-4, 1e5, 1.5, 300.0), (2e-4, 1e5, 0.0, 300.0)], "s double, sigma double, kappa double, t double")
    args = [F.col(c) for c in df.columns]
    out = df.select(F.struct(*(c.alias(n) for n, c in physics.propagate(*args, *(physics.default_error(a) for a in args)).items()))).collect()
    assert math.isclose(out[0][0]["zt_error"], 0.8 * math.sqrt(4 + 1 + 1 + 1) * 0.05) and out[1][0]["error_code"] == "KAPPA_NOT_POSITIVE"
    w = df.select(F.struct(*(c.alias(n) for n, c in physics.wiedemann_franz(F.col("sigma"), F.col("kappa"), F.col("t")).items()))).collect()
    assert math.isclose(w[0][0]["kappa_lattice"], 1.5 - 2.44e-8 * 1e5 * 300) and w[1][0]["error_code"] == "LATTICE_NEGATIVE"


def test_units(spark):
    df = spark.createDataFrame([(500.0, "uV/K"), (27.0, "degC"), (3.0, "furlong"), (None, "K"), (1.0, None)], "v double, u string")
    out = units.to_si(df, "v", "u", units.registry(spark)).collect()
    got = {r["u"]: (r["si_value"], r["si_unit"], r["unit_flag"]) for r in out}
    assert math.isclose(got["uV/K"][0], 5e-4) and math.isclose(got["degC"][0], 300.15)
    assert got["furlong"] == (3.0, "", 4) and got["K"] == (None, "K", 0) and got[None] == (1.0, "", 4)
    v, e = units.convert(F.lit(25.0), F.lit(0.5), "degC", "K")
    assert spark.range(1).select(v, e).first() == (298.15, 0.5)
    with pytest.raises(ValueError, match="dimension"):
        units.convert(F.lit(1.0), F.lit(0.0), "m", "K")


def test_quantities(spark):
    a, b, z = (units.quantity(F.lit(v), F.lit(0.1), [1, 0, 0, 0, 0, 0, 0]) for v in (3.0, 4.0, 0.0))
    t = units.quantity(F.lit(2.0), F.lit(0.1), [0, 0, 0, 0, 1, 0, 0])
    r = spark.range(1).select(units.add(a, b).alias("sum"), units.add(a, t).alias("bad"), units.multiply(a, b).alias("m"), units.divide(a, z).alias("zero"), units.divide(a, b).alias("q"), units.exponential(units.divide(a, a)).alias("e"), units.exponential(a).alias("no")).first()
    assert r["sum"]["value"] == 7 and r["bad"] is None and r["zero"] is None and r["no"] is None
    assert list(r["m"]["dim"]) == [2, 0, 0, 0, 0, 0, 0] and list(r["q"]["dim"]) == [0] * 7
    assert math.isclose(r["m"]["uncertainty"], 0.5) and math.isclose(r["e"]["value"], math.e)


def test_text(spark):
    df = spark.createDataFrame([("Bi2Te3",), ("Te3 Bi2",), ("PbTe",), ("",), (None,)], "c string")
    out = [r[0] for r in df.select(text.normalize_composition(F.col("c"))).collect()]
    assert out[0] == out[1] == "bi2te3" and out[2] == "pbte" and out[3] == "" and out[4] is None
    assert [r[0] for r in df.select(text.element_system(F.col("c"))).collect()] == ["Bi-Te", "Bi-Te", "Pb-Te", "Unknown", "Unknown"]
    e = spark.createDataFrame([("DFT calculation using VASP",), ("spark plasma sintering at 600 C",), ("sample prepared",), (None,)], "m string")
    assert [r[0] for r in e.select(text.experiment_class([F.col("m")])).collect()] == ["Computational", "Experimental", "Unknown", "Unknown"]
    k = spark.createDataFrame([(302.0, 802.0), (300.0, 800.0), (250.0, 800.0)], "a double, b double").select(text.dedup_key(F.lit("d"), F.lit("PbTe"), F.col("a"), F.col("b"))).collect()
    assert k[0] == k[1] != k[2]
    ids = spark.createDataFrame([("47",), (" 8 ",), ("4294967296",), ("x",), (None,), ("-1",)], "i string").select(text.flexible_id(F.col("i"))).collect()
    assert [r[0] for r in ids] == [47, 8, None, None, None, None]
    cells = spark.createDataFrame([("[1, 2.5]",), ("3",), ("[]",), ("x",), (None,)], "c string").select(text.last_of_list(F.col("c"))).collect()
    assert [r[0] for r in cells] == [2.5, 3.0, None, None, None]


def test_quality(spark):
    names = list(quality.WEIGHTS)
    df = spark.createDataFrame([(1.0,) * 6 + (True,), (1.0,) * 6 + (False,), (1.0,) * 5 + (NAN, False), (0.5,) * 6 + (True,)], ", ".join(f"{n} double" for n in names) + ", gate boolean")
    out = df.select(F.struct(*(c.alias(n) for n, c in quality.quality({n: F.col(n) for n in names}, F.col("gate"), 0.1).items()))).collect()
    got = [(r[0]["base_score"], r[0]["quality_class"], r[0]["error_code"]) for r in out]
    assert math.isclose(got[0][0], 1.0) and got[0][1] == 1 and got[1] == (0.0, 5, None) and got[2] == (None, None, "COMPONENT_OUT_OF_RANGE") and got[3][1] == 5
    with pytest.raises(ValueError, match="sum"):
        quality.check_weights({"a": 0.5})


def test_sigma_rho(spark):
    df = spark.createDataFrame([(100.0, 0.01), (100.0, 0.02), (100.0, 0.0), (100.0, -0.01), (None, 0.01)], "g double, r double")
    both = physics.sigma_rho_flag(F.col("g"), F.col("r"))
    assert [r[0] for r in df.select(both["flag"]).collect()] == [0, 8, 8, 0, 0]
    assert [r[0] for r in df.select(physics.sigma_rho_row_flag(F.lit(1), F.col("g"), F.col("r"))).collect()] == [1, 9, 1, 1, 1]
