"""Queries over the measurement corpus: one per operator family, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics, quality, text, units
from kelvinlake.operators import clean, curves, rank, states, stats
from kelvinlake.plans import pipelines
from kelvinlake.session import scratch_path, table, written
from kelvinlake.sinks import writers
from kelvinlake.sources import corpus, tabular
from kelvinlake.streaming import ingest

# ---- shared inputs ---------------------------------------------------------------------------------------------------

#: States derived from the order lines: values reach every branch of the audit.
_V_STATES = """
SELECT v.*, CASE WHEN line_no % 3 = 0 OR kappa <= 0e0 THEN NULL ELSE s*s*sigma*t/kappa*(1e0+(line_no-3)*4e-2) END AS zt_reported
FROM (SELECT l_orderkey AS sample_id, l_suppkey AS paper_id, l_linenumber AS line_no, 50e0 + l_quantity*40e0 AS t, (l_discount-5e-2)*2.2e-2 AS s,
             CASE WHEN l_partkey % 97 = 0 THEN l_extendedprice*1e3 ELSE l_extendedprice END AS sigma,
             CASE WHEN l_partkey % 89 = 0 THEN l_tax*4e3 ELSE l_tax*4e1 END AS kappa FROM lineitem) v
"""
_SCORES = """
SELECT o_orderkey AS id, (o_orderkey % 101) / 1e2 AS completeness, (o_custkey % 97) / 96e0 AS credibility, (o_orderkey % 89) / 88e0 AS physics_consistency,
       (o_custkey % 83) / 82e0 AS error_magnitude, (o_orderkey % 79) / 78e0 AS smoothness,
       CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN 12e-1 ELSE (o_custkey % 73) / 72e0 END AS metadata, o_custkey % 5 <> 0 AS gate
FROM orders
"""
_RANK = """
SELECT o_custkey AS material_id, CASE WHEN o_orderkey % 11 = 0 THEN 0e0 ELSE (1 + o_orderkey % 97) / 1e2 END AS p, o_totalprice / 1e5 AS zt, CAST(o_orderkey % 13 AS DOUBLE) - 1e0 AS c FROM orders
"""


def _view(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", "FROM {src}"), src=table(spark, sf_dir, name))


def v_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", _V_STATES)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fact_measurements")


def temperature_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).filter("property_id_x = 1")


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.state_table(temperature_facts(spark, sf_dir))


def branch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return physics.audit(v_states(spark, sf_dir))


def grid_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interpolated states under short names."""
    return table(spark, sf_dir, "interpolated_states").selectExpr(
        "row_id", "composition", "sampleid", "paperid", "CAST(temperature AS DOUBLE) AS t", "seebeck AS s", "electrical_conductivity AS sigma", "thermal_conductivity AS kappa", "CAST(NULL AS DOUBLE) AS zt_reported"
    )


_GRID = "SELECT row_id, composition, sampleid, paperid, CAST(temperature AS DOUBLE) AS t, seebeck AS s, electrical_conductivity AS sigma, thermal_conductivity AS kappa, CAST(NULL AS DOUBLE) AS zt_reported FROM interpolated_states"


def _audit_sql(src: str, s="s", sigma="sigma", kappa="kappa", t="t", zt="zt_reported", incomplete: int | None = None) -> str:
    missing = f"WHEN {s} IS NULL OR {sigma} IS NULL OR {kappa} IS NULL THEN {incomplete}" if incomplete is not None else ""
    return f"""
SELECT * EXCLUDE (alg, bnd, z, l, kl, er), CASE WHEN ok THEN z END AS zt_computed, CASE WHEN ok THEN kl END AS kappa_lattice, CASE WHEN ok THEN l END AS lorenz_number, er AS zt_error,
  CAST(CASE WHEN NOT ok THEN 4 WHEN {t} < 100 OR {t} > 2000 OR kl < 0 OR coalesce(er > 1e-1, false) THEN 3 WHEN l < 1e-9 OR l > 1e-7 THEN 2 ELSE 1 END AS INTEGER) AS audit_tier,
  CAST(CASE {missing} WHEN NOT alg THEN 2048 WHEN bnd > 0 THEN bnd + 2048
       ELSE (CASE WHEN {t} < 100 OR {t} > 2000 THEN 4096 ELSE 0 END) + (CASE WHEN l < 1e-9 OR l > 1e-7 OR kl < 0 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(er > 1e-1, false) THEN 2 ELSE 0 END) END AS INTEGER) AS anomaly_flags
FROM (SELECT *, CASE WHEN ok AND isfinite({zt}) AND abs({zt}) > 2.220446049250313e-16 THEN abs(z - {zt}) / abs({zt}) END AS er
 FROM (SELECT *, alg AND bnd = 0 AS ok, CASE WHEN alg THEN {s}*{s}*{sigma}*{t}/{kappa} END AS z, CASE WHEN alg THEN {kappa}/({sigma}*{t}) END AS l, {kappa} - 2.44e-8*{sigma}*{t} AS kl
  FROM (SELECT *, coalesce(isfinite({s}) AND isfinite({sigma}) AND isfinite({kappa}) AND isfinite({t}) AND {t} > 0 AND {sigma} > 0 AND {kappa} > 0, false) AS alg,
        CASE WHEN abs({s}) > 1e-3 THEN 64 WHEN {sigma} > 1e7 THEN 128 WHEN {kappa} > 100 THEN 256 ELSE 0 END AS bnd FROM ({src}) src)))
"""


_PIVOT = """
SELECT sample_id, paper_id, floor(x_si / 10) * 1e1 AS t_bin_k, avg(CASE WHEN property_id_y = 2 THEN y_si END) AS s_si,
       avg(CASE WHEN property_id_y = 3 THEN y_si WHEN property_id_y = 5 AND y_si > 0 THEN 1 / y_si END) AS sigma_si,
       avg(CASE WHEN property_id_y IN (4, 14) THEN y_si END) AS kappa_si,
       avg(CASE WHEN property_id_y = 5 THEN y_si WHEN property_id_y = 3 AND y_si > 0 THEN 1 / y_si END) AS rho_si,
       avg(CASE WHEN property_id_y = 16 THEN y_si WHEN property_id_y = 15 THEN y_si * x_si END) AS zt_reported, count(*) AS n_points
FROM fact_measurements WHERE property_id_x = 1 AND x_si > 0 AND isfinite(x_si) AND isfinite(y_si) GROUP BY 1, 2, 3 HAVING floor(x_si / 10) * 1e1 > 0
""".replace("HAVING floor(x_si / 10) * 1e1 > 0", "HAVING min(x_si) >= 10")
_AUDITED = _audit_sql(_PIVOT, "s_si", "sigma_si", "kappa_si", "t_bin_k", incomplete=0)
_BRANCHES = _audit_sql(_V_STATES)

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    """Register a query with its SQL, if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- the audit ------------------------------------------------------------------------------------------------------


@query(f"SELECT row_id, zt_computed, kappa_lattice, lorenz_number, audit_tier, anomaly_flags FROM ({_audit_sql(_GRID)})")
def physics_audit(spark, sf_dir):
    return physics.audit(grid_states(spark, sf_dir)).select("row_id", "zt_computed", "kappa_lattice", "lorenz_number", "audit_tier", "anomaly_flags")


@query(f"SELECT sample_id, paper_id, line_no, t, zt_computed, zt_error, audit_tier, anomaly_flags FROM ({_BRANCHES})")
def physics_audit_branches(spark, sf_dir):
    return branch_audit(spark, sf_dir).select("sample_id", "paper_id", "line_no", "t", "zt_computed", "zt_error", "audit_tier", "anomaly_flags")


@query(f"SELECT t.audit_tier, count(b.audit_tier) AS n, 1e2 * count(b.audit_tier) / sum(count(b.audit_tier)) OVER () AS percent FROM (SELECT unnest([1, 2, 3, 4]) AS audit_tier) t LEFT JOIN ({_BRANCHES}) b USING (audit_tier) GROUP BY 1")
def tier_distribution(spark, sf_dir):
    return stats.tier_distribution(branch_audit(spark, sf_dir))


@query(
    f"SELECT CAST(i AS INTEGER) AS bit, n AS flag, (SELECT count(*) FROM ({_BRANCHES}) WHERE audit_tier <= 3 AND (anomaly_flags >> i) & 1 = 1) AS n FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in enumerate(K.FLAGS))
    + ") f(i, n)"
)
def flag_frequency(spark, sf_dir):
    return stats.flag_frequency(branch_audit(spark, sf_dir))


@query(
    "SELECT anomaly_flags, concat_ws('|', " + ", ".join(f"CASE WHEN (anomaly_flags >> {i}) & 1 = 1 THEN '{n}' END" for i, n in enumerate(K.FLAGS)) + f") AS names, count(*) AS n FROM ({_BRANCHES}) GROUP BY ALL"
)
def decode_flags(spark, sf_dir):
    f = F.col("anomaly_flags")
    return branch_audit(spark, sf_dir).groupBy("anomaly_flags").agg(F.count(F.lit(1)).alias("n")).select("anomaly_flags", F.array_join(physics.decode_flags(f), "|").alias("names"), "n")


@query(
    f"""SELECT sample_id, paper_id, line_no, t, CASE WHEN isfinite(s) AND t > 0 AND kappa > 0 AND sigma > 0 AND abs(s) <= 1e-3 AND sigma <= 1e7 AND kappa <= 100
        THEN CASE WHEN kappa/(sigma*t) BETWEEN 1e-9 AND 1e-7 AND s*s*sigma*t/kappa BETWEEN 0 AND 4 THEN s*s*sigma*t/kappa END END AS zt FROM ({_V_STATES})"""
)
def zt_batch(spark, sf_dir):
    return v_states(spark, sf_dir).select("sample_id", "paper_id", "line_no", "t", physics.zt_batch(*(F.col(c) for c in ("s", "sigma", "kappa", "t"))).alias("zt"))


@query(
    f"""SELECT code AS error_code, count(*) AS n, round(avg(CASE WHEN code IS NULL THEN s*s*sigma*t/kappa END), 9) AS mean_zt FROM (SELECT *,
        CASE WHEN NOT coalesce(isfinite(s) AND isfinite(sigma) AND isfinite(kappa) AND isfinite(t), false) THEN 'NOT_FINITE' WHEN kappa <= 0 THEN 'KAPPA_NOT_POSITIVE' WHEN t <= 0 THEN 'T_NOT_POSITIVE'
        WHEN sigma <= 0 THEN 'SIGMA_NOT_POSITIVE' WHEN abs(s) > 1e-3 THEN 'SEEBECK_BOUND' WHEN sigma > 1e7 THEN 'SIGMA_BOUND' WHEN kappa > 100 THEN 'KAPPA_BOUND' WHEN t < 100 OR t > 2000 THEN 'TEMPERATURE_BOUND' END AS code
        FROM (SELECT s, sigma, kappa, t FROM ({_V_STATES}) UNION ALL SELECT s, sigma, kappa, t FROM ({_GRID}))) GROUP BY 1"""
)
def zt_strict_codes(spark, sf_dir):
    names = ("s", "sigma", "kappa", "t")
    both = v_states(spark, sf_dir).select(*names).unionByName(grid_states(spark, sf_dir).select(*names))
    return both.withColumns(physics.zt_strict(*(F.col(c) for c in names))).groupBy("error_code").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("zt"), 9).alias("mean_zt"))


@query(
    f"""SELECT row_id, CASE WHEN s IS NULL OR NOT isfinite(s) THEN 'S_NOT_FINITE' WHEN sigma IS NULL OR NOT isfinite(sigma) THEN 'SIGMA_NOT_FINITE' WHEN kappa IS NULL OR NOT isfinite(kappa) THEN 'KAPPA_NOT_FINITE'
        WHEN t IS NULL OR NOT isfinite(t) THEN 'T_NOT_FINITE' WHEN t <= 0 THEN 'T_NOT_POSITIVE' WHEN sigma <= 0 THEN 'SIGMA_NOT_POSITIVE' WHEN kappa <= 0 THEN 'KAPPA_NOT_POSITIVE' END AS error_code FROM ({_GRID})"""
)
def state_codes(spark, sf_dir):
    g = grid_states(spark, sf_dir)
    return g.select("row_id", physics.state_code(*(F.col(c) for c in ("s", "sigma", "kappa", "t", "zt_reported"))).alias("error_code"))


@query(f"SELECT sample_id, paper_id, line_no, t, 2.44e-8*sigma*t AS kappa_electronic, CASE WHEN kappa - 2.44e-8*sigma*t >= 0 THEN kappa - 2.44e-8*sigma*t END AS kappa_lattice, CASE WHEN kappa - 2.44e-8*sigma*t < 0 THEN 'LATTICE_NEGATIVE' END AS error_code, CASE WHEN sigma > 0 AND t > 0 THEN kappa/(sigma*t) END AS lorenz FROM ({_V_STATES})")
def wf_decomposition(spark, sf_dir):
    v = v_states(spark, sf_dir)
    sigma, kappa, t = (F.col(c) for c in ("sigma", "kappa", "t"))
    return v.select("sample_id", "paper_id", "line_no", "t", *(c.alias(n) for n, c in physics.wiedemann_franz(sigma, kappa, t).items()), physics.lorenz(sigma, kappa, t).alias("lorenz"))


@query(
    f"""SELECT count(*) AS n, count(*) FILTER (kappa - 2.44e-8*sigma*t < 0) AS n_sommerfeld, count(*) FILTER (kappa - 1.48e-8*sigma*t < 0) AS n_nondegenerate,
        1e2 * count(*) FILTER (kappa - 2.44e-8*sigma*t < 0) / count(*) AS pct_sommerfeld, 1e2 * count(*) FILTER (kappa - 1.48e-8*sigma*t < 0) / count(*) AS pct_nondegenerate
        FROM ({_GRID}) WHERE sigma > 0 AND kappa > 0 AND t > 0 AND isfinite(sigma) AND isfinite(kappa)"""
)
def wf_violation_rates(spark, sf_dir):
    sigma, kappa, t = (F.col(c) for c in ("sigma", "kappa", "t"))
    rows = grid_states(spark, sf_dir).filter((sigma > 0) & (kappa > 0) & (t > 0) & physics.finite(sigma) & physics.finite(kappa))
    bad = {"sommerfeld": kappa - K.L0 * sigma * t < 0, "nondegenerate": kappa - K.L0_NONDEGENERATE * sigma * t < 0}
    counted = rows.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(f"n_{k}") for k, c in bad.items()))
    return counted.select("*", *((F.try_divide(100.0 * F.col(f"n_{k}"), F.col("n"))).alias(f"pct_{k}") for k in bad))


_PROPAGATED = """CASE WHEN kappa > 0 AND t > 0 THEN s*s*sigma*t/kappa END AS zt,
 CASE WHEN kappa > 0 AND t > 0 THEN sqrt(pow(2*s*sigma*t/kappa*abs(s)*5e-2, 2) + pow(s*s*t/kappa*abs(sigma)*5e-2, 2) + pow(s*s*sigma*t/(kappa*kappa)*abs(kappa)*5e-2, 2) + pow(s*s*sigma/kappa*abs(t)*5e-2, 2)) END"""


@query(f"SELECT sample_id, paper_id, line_no, t, zt, round(e, 12) AS zt_error, CASE WHEN kappa <= 0 THEN 'KAPPA_NOT_POSITIVE' WHEN t <= 0 THEN 'T_NOT_POSITIVE' END AS error_code FROM (SELECT *, {_PROPAGATED} AS e FROM ({_V_STATES}))")
def error_propagation(spark, sf_dir):
    v = v_states(spark, sf_dir)
    args = [F.col(c) for c in ("s", "sigma", "kappa", "t")]
    out = physics.propagate(*args, *(physics.default_error(a) for a in args))
    out["zt_error"] = F.round(out["zt_error"], 12)
    return v.select("sample_id", "paper_id", "line_no", "t", *(c.alias(n) for n, c in out.items()))


# ---- states ---------------------------------------------------------------------------------------------------------

_R = {"s_si": 14, "sigma_si": 6, "kappa_si": 9, "rho_si": 14, "zt_reported": 12}


def _rounded(columns: dict[str, int]) -> list:
    return [(F.round(c, n) + 0.0).alias(c) for c, n in columns.items()]  # + 0.0: no negative zero


def _rounded_sql(columns: dict[str, int]) -> str:
    return ", ".join(f"round({c}, {n}) + 0e0 AS {c}" for c, n in columns.items())


@query(f"SELECT sample_id, paper_id, t_bin_k, n_points, {_rounded_sql(_R)} FROM ({_PIVOT})")
def state_pivot(spark, sf_dir):
    return states.pivot_states(temperature_facts(spark, sf_dir)).select("sample_id", "paper_id", "t_bin_k", "n_points", *_rounded(_R))


_RR = {"s": 14, "sigma": 6, "kappa": 9, "rho": 14, "zt": 9}


@query(
    f"""SELECT sample_id, t_round_k, {_rounded_sql(_RR)} FROM (SELECT sample_id, t_round_k, s, coalesce(g, CASE WHEN rho > 1e-12 THEN 1 / rho END) AS sigma, kappa, rho, zt FROM (
        SELECT sample_id, round_even(x_si / 10, 0) * 1e1 AS t_round_k, avg(CASE WHEN property_id_y = 2 THEN y_si END) AS s, avg(CASE WHEN property_id_y = 3 THEN y_si END) AS g, avg(CASE WHEN property_id_y = 4 THEN y_si END) AS kappa,
        avg(CASE WHEN property_id_y = 5 THEN y_si END) AS rho, avg(CASE WHEN property_id_y = 16 THEN y_si END) AS zt FROM fact_measurements
        WHERE property_id_x = 1 AND property_id_y IN (2, 3, 4, 5, 16) AND isfinite(x_si) AND isfinite(y_si) GROUP BY 1, 2))"""
)
def state_pivot_rounded(spark, sf_dir):
    return states.pivot_rounded(temperature_facts(spark, sf_dir)).select("sample_id", "t_round_k", *_rounded(_RR))


@query(f"SELECT sample_id, paper_id, t_bin_k, audit_tier, anomaly_flags, round(zt_computed, 6) AS zt_computed, round(zt_error, 6) AS zt_error FROM ({_AUDITED})")
def state_pipeline(spark, sf_dir):
    return audited(spark, sf_dir).select("sample_id", "paper_id", "t_bin_k", "audit_tier", "anomaly_flags", F.round("zt_computed", 6).alias("zt_computed"), F.round("zt_error", 6).alias("zt_error"))


@query(
    "SELECT row_number() OVER (ORDER BY sample_id, paper_id, t_bin_k) - 1 AS state_id, sample_id, paper_id, t_bin_k FROM (" + _PIVOT + ")"
)
def state_ids(spark, sf_dir):
    out = clean.surrogate_ids(states.pivot_states(temperature_facts(spark, sf_dir)).select("sample_id", "paper_id", "t_bin_k"), ["sample_id", "paper_id", "t_bin_k"])
    return out.select("state_id", "sample_id", "paper_id", "t_bin_k")


# ---- ingest and cleaning --------------------------------------------------------------------------------------------

_ALLOWED = ", ".join(map(str, K.ALLOWED_PROPERTIES))
_KEPT = f"isfinite(x_si) AND isfinite(y_si) AND property_id_y IN ({_ALLOWED})"


@query(f"SELECT property_id_y, count(*) AS n_points, count(*) FILTER ({_KEPT}) AS n_kept, count(*) - count(*) FILTER ({_KEPT}) AS n_rejected FROM fact_measurements GROUP BY 1")
def ingest_counters(spark, sf_dir):
    return clean.ingest_counters(facts(spark, sf_dir))


@query(
    "SELECT property_id_y, side, count(*) AS n_points FROM (SELECT property_id_y, CASE WHEN y_si < lo THEN 'below' WHEN y_si > hi THEN 'above' END AS side FROM fact_measurements JOIN (VALUES "
    + ", ".join(f"({i}, {a!r}::DOUBLE, {b!r}::DOUBLE)" for i, (a, b) in K.POLICY_BOUNDS.items())
    + ") p(i, lo, hi) ON i = property_id_y WHERE isfinite(y_si)) WHERE side IS NOT NULL GROUP BY ALL"
)
def policy_violations(spark, sf_dir):
    return clean.policy_violations(facts(spark, sf_dir))


@query("SELECT property_id_y, count(*) AS n_points, count(*) FILTER (NOT EXISTS (SELECT 1 FROM dim_figures f WHERE f.figure_id = m.figure_id AND f.paper_id = m.paper_id)) AS n_mismatch FROM fact_measurements m GROUP BY 1".replace("count(*) FILTER (NOT EXISTS (SELECT 1 FROM dim_figures f WHERE f.figure_id = m.figure_id AND f.paper_id = m.paper_id))", "count(*) - count(f.known)").replace("FROM fact_measurements m", "FROM fact_measurements m LEFT JOIN (SELECT DISTINCT figure_id, paper_id, 1 AS known FROM dim_figures) f ON f.figure_id = m.figure_id AND f.paper_id = m.paper_id"))
def figure_reference_check(spark, sf_dir):
    out = clean.figure_mismatch(facts(spark, sf_dir), table(spark, sf_dir, "dim_figures"))
    return out.groupBy("property_id_y").agg(F.count(F.lit(1)).alias("n_points"), F.count_if(F.col("anomaly_flags") != 0).alias("n_mismatch"))


_FIRST = "SELECT * FROM fact_measurements QUALIFY row_number() OVER (PARTITION BY paper_id, figure_id, sample_id, property_id_y, round_even(x_raw * 1e3, 0) ORDER BY CASE source_domain WHEN 'samples' THEN 0 WHEN 'papers' THEN 1 WHEN 'figures' THEN 2 ELSE 9 END, source_file NULLS FIRST, measurement_id) = 1"


@query(f"SELECT measurement_id, source_domain FROM ({_FIRST})")
def cross_domain_dedup(spark, sf_dir):
    return clean.cross_domain_dedup(facts(spark, sf_dir).select("measurement_id", "source_domain", "source_file", "paper_id", "figure_id", "sample_id", "property_id_y", "x_raw")).select("measurement_id", "source_domain")


_ROW_KEY = "sha256(concat_ws(chr(0), coalesce(CAST(paperid AS VARCHAR), ''), list_aggregate(list_sort(list_filter(regexp_split_to_array(coalesce(composition, ''), '[\\s,]+'), lambda x: x <> '')), 'string_agg', ' '), coalesce(CAST(CAST(floor(temperature / 50) * 50 AS BIGINT) AS VARCHAR), 'NA')))"


@query(f"SELECT row_id, CASE WHEN row_number() OVER (PARTITION BY {_ROW_KEY} ORDER BY row_id) = 1 THEN 0 ELSE 1024 END AS dup_flag FROM interpolated_states")
def dedup_flags_row(spark, sf_dir):
    rows = table(spark, sf_dir, "interpolated_states").select("row_id", "paperid", "composition", "temperature")
    return clean.duplicate_flags(rows, text.row_dedup_key(F.col("paperid"), F.col("composition"), F.col("temperature")), ["row_id"]).select("row_id", "dup_flag")


@query(
    """SELECT paperid, composition, sha256(concat_ws('|', CAST(paperid AS VARCHAR), list_aggregate(list_sort(list_transform(regexp_extract_all(regexp_replace(composition, '\\s', '', 'g'), '[A-Z]?[^A-Z]+|[A-Z]'), lambda x: lower(x))), 'string_agg', ''),
       concat('Tmin_', CAST(CAST(floor(min(temperature) / 50) * 50 AS BIGINT) AS VARCHAR), '_Tmax_', CAST(CAST(floor(max(temperature) / 50) * 50 AS BIGINT) AS VARCHAR)))) AS dedup_key
       FROM interpolated_states WHERE paperid IS NOT NULL AND composition IS NOT NULL AND temperature IS NOT NULL GROUP BY paperid, composition"""
)
def dedup_range_key(spark, sf_dir):
    rows = table(spark, sf_dir, "interpolated_states").filter("paperid IS NOT NULL AND composition IS NOT NULL AND temperature IS NOT NULL")
    spans = rows.groupBy("paperid", "composition").agg(F.min("temperature").alias("a"), F.max("temperature").alias("b"))
    return spans.select("paperid", "composition", text.dedup_key(F.col("paperid").cast("string"), F.col("composition"), F.col("a"), F.col("b")).alias("dedup_key"))


@query("SELECT source_domain, count(*) AS n_points, count(DISTINCT source_file) AS n_files FROM fact_measurements GROUP BY 1")
def domain_union(spark, sf_dir):
    f = facts(spark, sf_dir).select("source_domain", "source_file")
    parts = [f.filter(F.col("source_domain") == d) for d in K.DOMAIN_PRIORITY]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(f.filter(F.col("source_domain").isNull() | ~F.col("source_domain").isin(*K.DOMAIN_PRIORITY)))
    return whole.groupBy("source_domain").agg(F.count(F.lit(1)).alias("n_points"), F.countDistinct("source_file").alias("n_files"))


@query(
    """SELECT source, count(*) AS n, count(*) FILTER (v > 1e7) AS n_above, round(avg(ln(v)), 8) AS mean_log FROM (SELECT 'direct' AS source, y_si AS v FROM fact_measurements WHERE property_id_y = 3 AND y_si > 0 AND isfinite(y_si)
       UNION ALL SELECT 'inverse', 1 / y_si FROM fact_measurements WHERE property_id_y = 5 AND y_si > 0 AND isfinite(y_si)) GROUP BY 1"""
)
def sigma_union_rho(spark, sf_dir):
    f = facts(spark, sf_dir).filter((F.col("y_si") > 0) & physics.finite(F.col("y_si")))
    direct = f.filter("property_id_y = 3").select(F.lit("direct").alias("source"), F.col("y_si").alias("v"))
    inverse = f.filter("property_id_y = 5").select(F.lit("inverse").alias("source"), (1 / F.col("y_si")).alias("v"))
    return direct.unionAll(inverse).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") > K.SIGMA_MAX).alias("n_above"), F.round(F.avg(F.ln("v")), 8).alias("mean_log"))


@query(
    """SELECT property_id_y, count(*) AS n, count(*) FILTER (abs(y_si) * 1e6 > 1000) AS n_over_1000, count(*) FILTER (abs(y_si) * 1e6 > 10000) AS n_over_10000, count(*) FILTER (y_si > 100) AS n_over_100
       FROM fact_measurements WHERE property_id_y IN (2, 4) AND isfinite(y_si) GROUP BY 1"""
)
def threshold_exceedances(spark, sf_dir):
    v = F.col("y_si")
    rows = facts(spark, sf_dir).filter(F.col("property_id_y").isin(2, 4) & physics.finite(v))
    return rows.groupBy("property_id_y").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(v) * 1e6 > 1000).alias("n_over_1000"), F.count_if(F.abs(v) * 1e6 > 10000).alias("n_over_10000"), F.count_if(v > 100).alias("n_over_100"))


_INSERTED = "SELECT sample_id, paper_id, row_id FROM dim_samples WHERE deleted_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sample_id, paper_id ORDER BY row_id) = 1"


@query(
    f"""WITH old AS ({_INSERTED}) SELECT * FROM old UNION ALL SELECT sample_id, paper_id, row_id FROM dim_samples n WHERE deleted_at IS NULL AND NOT EXISTS (SELECT 1 FROM old o WHERE o.sample_id = n.sample_id AND o.paper_id = n.paper_id)
        QUALIFY row_number() OVER (PARTITION BY sample_id, paper_id ORDER BY row_id) = 1"""
)
def insert_or_ignore_dims(spark, sf_dir):
    s = table(spark, sf_dir, "dim_samples").select("sample_id", "paper_id", "row_id", "deleted_at")
    old = clean.keep_first(s.filter("deleted_at IS NOT NULL").drop("deleted_at"), ["sample_id", "paper_id"], ["row_id"])
    return clean.insert_or_ignore(old, s.filter("deleted_at IS NULL").drop("deleted_at"), ["sample_id", "paper_id"], ["row_id"])


@query(
    """SELECT CAST(op AS VARCHAR) AS op, count(*) AS n, count(DISTINCT paper_id) AS n_papers FROM (SELECT coalesce(o.paper_id, n.paper_id) AS paper_id, CASE WHEN o.paper_id IS NULL THEN 'INSERT' WHEN n.paper_id IS NULL THEN 'DELETE' WHEN o.title IS DISTINCT FROM n.title OR o.doi IS DISTINCT FROM n.doi THEN 'UPDATE' END AS op
       FROM (SELECT paper_id, title, doi FROM dim_papers WHERE ingested_at < TIMESTAMP '2023-01-01' QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY ingested_at DESC, title, doi NULLS FIRST) = 1) o
       FULL JOIN (SELECT paper_id, title, doi FROM dim_papers WHERE deleted_at IS NULL QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY ingested_at DESC, title, doi NULLS FIRST) = 1) n ON o.paper_id = n.paper_id) WHERE op IS NOT NULL GROUP BY 1"""
)
def audit_change_log(spark, sf_dir):
    p = table(spark, sf_dir, "dim_papers").select("paper_id", "title", "doi", "ingested_at", "deleted_at")
    order = [-F.unix_micros(F.col("ingested_at").cast("timestamp")), "title", "doi"]
    pick = lambda df: clean.keep_first(df, ["paper_id"], order).select("paper_id", "title", "doi")
    log = clean.change_log(pick(p.filter(F.col("ingested_at") < F.lit("2023-01-01").cast("timestamp_ntz"))), pick(p.filter("deleted_at IS NULL")), ["paper_id"])
    return log.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("paper_id").alias("n_papers"))


@query(
    """SELECT rule, count(*) AS n FROM (SELECT unnest([CASE WHEN NOT coalesce(source_domain IN ('samples', 'papers', 'figures'), false) THEN 'domain_known' END, CASE WHEN NOT coalesce(x_si > 0, false) THEN 'x_positive' END,
       CASE WHEN NOT coalesce(isfinite(y_si), false) THEN 'y_finite' END]) AS rule FROM fact_measurements) WHERE rule IS NOT NULL GROUP BY 1"""
)
def constraint_violations(spark, sf_dir):
    rules = {"domain_known": F.col("source_domain").isin(*K.DOMAIN_PRIORITY), "x_positive": F.col("x_si") > 0, "y_finite": physics.finite(F.col("y_si"))}
    return clean.constraint_violations(facts(spark, sf_dir), rules, "measurement_id").groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT m.paper_id, count(*) AS n_rows FROM fact_measurements m WHERE NOT EXISTS (SELECT 1 FROM dim_samples s WHERE s.sample_id = m.sample_id AND s.paper_id = m.paper_id) GROUP BY 1"""
)
def referential_integrity(spark, sf_dir):
    keys = ["sample_id", "paper_id"]
    counted = facts(spark, sf_dir).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(table(spark, sf_dir, "dim_samples").select(*keys).distinct(), keys, "left_anti").groupBy("paper_id").agg(F.sum("n").alias("n_rows"))


# ---- units ----------------------------------------------------------------------------------------------------------

_REGISTRY = ", ".join(f"('{u}', {f!r}::DOUBLE, {o!r}::DOUBLE)" for u, _, _, f, o in units.REGISTRY)
_RAW_UNITS = """SELECT measurement_id, x_raw, y_raw, CASE property_id_y WHEN 2 THEN CASE measurement_id % 4 WHEN 0 THEN 'V/K' WHEN 1 THEN 'uV/K' WHEN 2 THEN 'mV/K' ELSE 'nV/K' END WHEN 3 THEN CASE measurement_id % 3 WHEN 0 THEN 'S/m' WHEN 1 THEN 'S/cm' ELSE 'kS' END
  WHEN 4 THEN CASE measurement_id % 2 WHEN 0 THEN 'W/mK' ELSE 'mW/mK' END WHEN 5 THEN CASE measurement_id % 3 WHEN 0 THEN 'ohm*m' WHEN 1 THEN 'mohm*cm' ELSE NULL END ELSE 'degC' END AS unit_raw, property_id_y FROM fact_measurements"""


@query(f"SELECT measurement_id, CASE WHEN u IS NULL THEN y_raw ELSE y_raw * f + o END AS si_value, CASE WHEN u IS NULL THEN 4 ELSE 0 END AS unit_flag FROM ({_RAW_UNITS}) LEFT JOIN (VALUES {_REGISTRY}) r(u, f, o) ON u = unit_raw")
def unit_conversion(spark, sf_dir):
    raw = _view(spark, sf_dir, "fact_measurements", _RAW_UNITS)
    return units.to_si(raw, "y_raw", "unit_raw", units.registry(spark)).select("measurement_id", "si_value", "unit_flag")


@query(
    """SELECT measurement_id, CASE WHEN property_id_y = p.property_id THEN y_raw * p.si_factor END AS y_normalized FROM fact_measurements LEFT JOIN (SELECT DISTINCT property_id, si_factor FROM dim_properties) p ON p.property_id = property_id_y"""
)
def si_normalization(spark, sf_dir):
    p = table(spark, sf_dir, "dim_properties").select(F.col("property_id").alias("property_id_y"), "si_factor").distinct()
    return facts(spark, sf_dir).select("measurement_id", "property_id_y", "y_raw").join(p, "property_id_y", "left").select("measurement_id", (F.col("y_raw") * F.col("si_factor")).alias("y_normalized"))


_UNIT_TEXTS = """SELECT measurement_id, y_raw, property_id_y, CASE property_id_y WHEN 2 THEN CASE measurement_id % 3 WHEN 0 THEN 'V/K' WHEN 1 THEN 'uV/K' ELSE 'mV/K' END WHEN 3 THEN CASE measurement_id % 4 WHEN 0 THEN 'S/m' WHEN 1 THEN 'S/cm' WHEN 2 THEN '10^3 S/m' ELSE '10^4 S/m' END
  WHEN 4 THEN CASE measurement_id % 3 WHEN 0 THEN 'W/mK' WHEN 1 THEN 'mW/cmK' ELSE 'mW/m^1K' END WHEN 5 THEN CASE measurement_id % 5 WHEN 0 THEN 'Ohm*m' WHEN 1 THEN 'mOhm*cm' WHEN 2 THEN 'uOhm*cm' WHEN 3 THEN 'Ohm*cm' ELSE 'uOhm*m' END END AS unit_raw FROM fact_measurements"""


@query(
    f"""SELECT measurement_id, y_raw
        * CASE WHEN property_id_y = 2 AND regexp_matches(unit_raw, 'uV|muV|μV') THEN 1e-6 ELSE 1e0 END * CASE WHEN property_id_y = 2 AND regexp_matches(unit_raw, 'mV') THEN 1e-3 ELSE 1e0 END
        * CASE WHEN property_id_y = 3 AND regexp_matches(unit_raw, 'cm') THEN 1e2 ELSE 1e0 END * CASE WHEN property_id_y = 3 AND contains(unit_raw, '10^3') THEN 1e3 ELSE 1e0 END * CASE WHEN property_id_y = 3 AND contains(unit_raw, '10^4') THEN 1e4 ELSE 1e0 END
        * CASE WHEN property_id_y = 5 AND regexp_matches(unit_raw, 'mOhm.*cm') THEN 1e-5 ELSE 1e0 END * CASE WHEN property_id_y = 5 AND regexp_matches(unit_raw, 'uOhm.*cm|μOhm.*cm') THEN 1e-8 ELSE 1e0 END
        * CASE WHEN property_id_y = 5 AND regexp_matches(unit_raw, 'Ohm.*cm') AND NOT regexp_matches(unit_raw, 'mOhm|uOhm|μOhm') THEN 1e-2 ELSE 1e0 END * CASE WHEN property_id_y = 5 AND regexp_matches(unit_raw, 'uOhm.*m|μOhm.*m') AND NOT contains(unit_raw, 'cm') THEN 1e-6 ELSE 1e0 END
        * CASE WHEN property_id_y = 4 AND regexp_matches(unit_raw, 'mW.*cm|cm.*mW') THEN 0.1e0 ELSE 1e0 END * CASE WHEN property_id_y = 4 AND (unit_raw LIKE '%mW%m^%' OR unit_raw LIKE '%m^%mW%') THEN 1e-3 ELSE 1e0 END AS scaled FROM ({_UNIT_TEXTS})"""
)
def unit_text_scaling(spark, sf_dir):
    raw = _view(spark, sf_dir, "fact_measurements", _UNIT_TEXTS)
    role = F.when(F.col("property_id_y") == 2, "S").when(F.col("property_id_y") == 3, "Sigma").when(F.col("property_id_y") == 5, "Rho").when(F.col("property_id_y") == 4, "Kappa")
    return raw.select("measurement_id", units.scale_by_text(F.col("y_raw"), F.col("unit_raw"), role, units.TEXT_RULES).alias("scaled"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 273.15e0 AS kelvin, l_quantity * l_discount AS product, round(sqrt(pow(l_quantity * 1e-2, 2) + pow(l_discount * 1e-1, 2)), 10) AS product_error,
       l_quantity - l_discount AS difference, CASE WHEN l_tax <> 0 THEN l_quantity / l_tax END AS quotient, '[1, 0, 0, 0, 1, 0, 0]' AS product_dim FROM lineitem"""
)
def quantity_algebra(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    length, kelvin = units.UNITS["m"][0], units.UNITS["K"][0]
    a = units.quantity(F.col("l_quantity"), F.lit(0.1), length)
    b = units.quantity(F.col("l_discount"), F.lit(0.01), kelvin)
    same = units.quantity(F.col("l_discount"), F.lit(0.01), length)
    c = units.quantity(F.col("l_tax"), F.lit(0.01), kelvin)
    q = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", units.multiply(a, b).alias("m"), units.add(a, same, -1).alias("d"), units.divide(a, c).alias("q"))
    return q.select(
        "l_orderkey", "l_linenumber", "l_partkey", units.convert(F.col("l_quantity").cast("double"), F.lit(0.1), "degC", "K")[0].alias("kelvin"), F.col("m.value").alias("product"), F.round("m.uncertainty", 10).alias("product_error"), F.col("d.value").alias("difference"), F.col("q.value").alias("quotient"), F.concat(F.lit("["), F.array_join("m.dim", ", "), F.lit("]")).alias("product_dim"),
    )


@query(
    f"""SELECT sample_id, paper_id, t_bin_k, CASE WHEN abs(sigma_si * rho_si - 1) > 5e-2 AND sigma_si > 0 AND rho_si > 0 THEN 8 ELSE 0 END AS row_flag, CASE WHEN rho_si = 0 THEN 8 WHEN rho_si IS NOT NULL AND abs(sigma_si - 1 / rho_si) / (1 / rho_si) > 5e-2 THEN 8 ELSE 0 END AS deviation_flag FROM ({_PIVOT})"""
)
def sigma_rho_consistency(spark, sf_dir):
    p = states.pivot_states(temperature_facts(spark, sf_dir))
    g, r = F.col("sigma_si"), F.col("rho_si")
    return p.select("sample_id", "paper_id", "t_bin_k", physics.sigma_rho_row_flag(F.lit(0), g, r).alias("row_flag"), physics.sigma_rho_flag(g, r)["flag"].alias("deviation_flag"))


# ---- quality, ranking, inference ------------------------------------------------------------------------------------

_PARTS = tuple(quality.WEIGHTS)
_BASE = " + ".join(f"{w!r}::DOUBLE * {k}" for k, w in quality.WEIGHTS.items())
_H = " + ".join(f"(CASE WHEN {k} > 0 THEN -{k} * ln({k}) ELSE 0e0 END)" for k in _PARTS)
_VALID = " AND ".join(f"coalesce({k} BETWEEN 0 AND 1, false)" for k in _PARTS)


def _clamped(x: str) -> str:
    return f"greatest(0e0, least(1e0, {x}))"


@query(
    f"""SELECT id, round(CASE WHEN ok AND gate THEN b WHEN ok THEN 0 END, 10) AS base_score, round(CASE WHEN ok AND gate THEN sc WHEN ok THEN 0 END, 10) AS score,
        CAST(CASE WHEN ok AND gate THEN CASE WHEN sc >= 0.9 THEN 1 WHEN sc >= 0.8 THEN 2 WHEN sc >= 0.65 THEN 3 WHEN sc >= 0.5 THEN 4 ELSE 5 END WHEN ok THEN 5 END AS INTEGER) AS quality_class, CASE WHEN NOT ok THEN 'COMPONENT_OUT_OF_RANGE' END AS error_code
        FROM (SELECT *, {_BASE} AS b, {_VALID} AS ok, {_clamped(f"({_BASE}) - 5e-2 * ({_H})")} AS sc FROM ({_SCORES}))"""
)
def quality_score(spark, sf_dir):
    q = _view(spark, sf_dir, "orders", _SCORES)
    out = quality.quality({k: F.col(k) for k in _PARTS}, F.col("gate"), 0.05)
    return q.select("id", F.round(out["base_score"], 10).alias("base_score"), F.round(out["score"], 10).alias("score"), out["quality_class"].cast("int").alias("quality_class"), out["error_code"].alias("error_code"))


@query(
    f"""SELECT id, round(c, 10) AS credibility, CASE WHEN c >= 0.9 THEN 'A' WHEN c >= 0.75 THEN 'B' WHEN c >= 0.5 THEN 'C' ELSE 'D' END AS credibility_class FROM (SELECT id, {_clamped("completeness * (CASE WHEN id % 4 >= 1 THEN 1 - exp(-CAST(id % 4 AS DOUBLE)) ELSE 0 END) * smoothness * (CASE WHEN error_magnitude > 0 THEN exp(-5e-1 * error_magnitude) ELSE 1 END) * ((id % 50) / ((id % 50) + 5e0)) * exp(-1e0 * physics_consistency) * exp(-1e-2 * (id % 30))")} AS c FROM ({_SCORES}))"""
)
def credibility_score(spark, sf_dir):
    q = _view(spark, sf_dir, "orders", _SCORES)
    c = quality.credibility(F.col("completeness"), F.col("id") % 4, F.col("smoothness"), F.col("error_magnitude"), F.col("id") % 50, F.col("physics_consistency"), (F.col("id") % 30).cast("double"), 0.5, 5.0, 1.0, 0.01)
    return q.withColumn("c", c).select("id", F.round("c", 10).alias("credibility"), quality.credibility_class(F.col("c")).alias("credibility_class"))


_PROD = " * ".join(f"pow({k}, {w!r}::DOUBLE)" for k, w in quality.WEIGHTS.items())
_SPREAD = " + ".join(f"{w * w!r}::DOUBLE * 1e-2" for w in quality.WEIGHTS.values())


@query(
    f"""SELECT id, round(CASE WHEN gate THEN {_BASE} ELSE 0 END, 10) AS linear, round(CASE WHEN gate THEN {_PROD} ELSE 0 END, 10) AS multiplicative, round(CASE WHEN gate THEN {_clamped(f"({_BASE}) - 1e-1 * ({_H})")} ELSE 0 END, 10) AS entropy_regularized,
        round(CASE WHEN gate THEN {_clamped(f"({_BASE}) - 5e-1 * sqrt({_SPREAD})")} ELSE 0 END, 10) AS risk_adjusted FROM ({_SCORES}) WHERE {_VALID}"""
)
def score_variants(spark, sf_dir):
    q = _view(spark, sf_dir, "orders", _SCORES)
    parts = {k: F.col(k) for k in _PARTS}
    for k in _PARTS:
        q = q.filter(F.col(k).between(0, 1))
    gate = F.col("gate")
    out = {"linear": quality.score_linear(parts, gate), "multiplicative": quality.score_multiplicative(parts, gate), "entropy_regularized": quality.score_entropy(parts, gate, 0.1), "risk_adjusted": quality.score_risk(parts, {k: F.lit(0.1) for k in _PARTS}, gate, 0.5)}
    return q.select("id", *(F.round(c, 10).alias(n) for n, c in out.items()))


@query("SELECT DISTINCT power_factor, x FROM (SELECT seebeck * seebeck * electrical_conductivity * 1e3 AS power_factor, -thermal_conductivity AS x FROM interpolated_states WHERE seebeck IS NOT NULL AND thermal_conductivity > 0 AND electrical_conductivity > 0) QUALIFY x > coalesce(max(x) OVER (ORDER BY power_factor DESC, x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1e308)")
def pareto_front(spark, sf_dir):
    g = grid_states(spark, sf_dir).filter("s IS NOT NULL AND kappa > 0 AND sigma > 0")
    both = g.select("row_id", physics.power_factor_mw(F.col("s"), F.col("sigma")).alias("power_factor"), (-F.col("kappa")).alias("x"))
    return rank.pareto_front(both, ["power_factor", "x"]).select("power_factor", "x").distinct()


_RANKED = f"""SELECT material_id, CASE WHEN w > 2.220446049250313e-16 THEN wz / w ELSE 0 END AS relevance, h AS entropy, (CASE WHEN w > 2.220446049250313e-16 THEN wz / w ELSE 0 END) - 1e-1 * h AS score FROM (
 SELECT material_id, sum((1 + ln(1 + greatest(c, 0))) * p) AS w, sum((1 + ln(1 + greatest(c, 0))) * p * zt) AS wz, sum(CASE WHEN p > 2.220446049250313e-16 THEN -p * ln(p) ELSE 0 END) AS h FROM ({_RANK}) GROUP BY 1)"""


@query(f"SELECT material_id, round(relevance, 9) AS relevance, round(entropy, 9) AS entropy, round(score, 9) AS score FROM ({_RANKED})")
def material_rank(spark, sf_dir):
    return rank.material_rank(_view(spark, sf_dir, "orders", _RANK)).select("material_id", *_rounded({"relevance": 9, "entropy": 9, "score": 9}))


@query(f"SELECT material_id, round(score, 9) AS score FROM ({_RANKED}) ORDER BY score DESC, material_id LIMIT 10")
def material_rank_top10(spark, sf_dir):
    return rank.top(rank.material_rank(_view(spark, sf_dir, "orders", _RANK)), "score", 10, "material_id").select("material_id", F.round("score", 9).alias("score"))


@query(
    """SELECT paper_id, n AS n_points, round(h, 8) + 0e0 AS entropy, round(ln(10) - h, 8) + 0e0 AS divergence, round(h + 5e-1 * (ln(10) - h), 8) + 0e0 AS gap_score FROM (SELECT paper_id, CAST(sum(n) AS BIGINT) AS n, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM (
       SELECT paper_id, greatest(0, least(9, floor((x_si - 300) / 90))) AS b, count(*) AS n FROM fact_measurements WHERE property_id_x = 1 AND isfinite(x_si) GROUP BY 1, 2) GROUP BY 1)"""
)
def information_gain(spark, sf_dir):
    out = rank.information_gain(temperature_facts(spark, sf_dir), "paper_id", "x_si", gamma1=1.0, gamma2=0.5)
    return out.select("paper_id", "n_points", *_rounded({"entropy": 8, "divergence": 8, "gap_score": 8}))


_LL = f"""SELECT sample_id, paper_id, line_no, t, lw FROM (SELECT *, -0.5 * pow((zt_reported - s*s*sigma*t/kappa) / 1e-1, 2) - ln(1e-1) - 0.5 * ln(6.283185307179586) - 1e-2 * pow(greatest(0, 2.44e-8*sigma*t - kappa), 2) + ln((1 + line_no) / 8e0) AS lw FROM ({_V_STATES}) WHERE kappa > 0 AND zt_reported IS NOT NULL)"""


@query(f"SELECT sample_id, paper_id, line_no, t, round(exp(lw - max(lw) OVER ()) / sum(exp(lw)) OVER () * exp(max(lw) OVER ()), 12) AS posterior FROM ({_LL})")
def bayes_posterior(spark, sf_dir):
    v = v_states(spark, sf_dir).filter("kappa > 0 AND zt_reported IS NOT NULL")
    c = {n: F.col(n) for n in ("s", "sigma", "kappa", "t")}
    weighted = v.withColumn("lw", physics.log_likelihood(*c.values(), F.col("zt_reported"), F.lit(0.1), 0.01) + rank.log_prior((1 + F.col("line_no")) / 8.0))
    return rank.posterior(weighted, "lw").select("sample_id", "paper_id", "line_no", "t", F.round("posterior", 12).alias("posterior"))


# ---- statistics -----------------------------------------------------------------------------------------------------

_D = {"mean": 8, "sd": 8, "least": 8, "p05": 8, "p25": 8, "p50": 8, "p75": 8, "p95": 8, "largest": 8}


def _describe_sql(src: str, by: str, v: str) -> str:
    q = ", ".join(f"round(quantile_cont({v}, {p}), 8) AS p{round(p * 100):02d}" for p in stats.QUANTILES)
    return f"SELECT {by}, count(*) AS n, round(avg({v}), 8) AS mean, round(stddev_samp({v}), 8) AS sd, round(min({v}), 8) AS least, {q}, round(max({v}), 8) AS largest FROM ({src}) WHERE isfinite({v}) GROUP BY {by}"


_RAW_CLEAN = """SELECT property_id_y, property_id_x = 1 AND CASE property_id_y WHEN 2 THEN abs(y_si) <= 1e-3 WHEN 3 THEN y_si > 0 AND y_si <= 1e7 WHEN 4 THEN y_si > 0 AND y_si <= 100 ELSE y_si BETWEEN 0 AND 4 END AS is_clean,
 CASE property_id_y WHEN 2 THEN y_si * 1e6 WHEN 3 THEN y_si * 1e-3 ELSE y_si END AS v FROM fact_measurements WHERE property_id_y IN (2, 3, 4, 16) AND abs(y_si) < 1e300"""


@query(_describe_sql(_RAW_CLEAN, "property_id_y, is_clean", "v"))
def describe_raw_vs_clean(spark, sf_dir):
    out = stats.describe(_view(spark, sf_dir, "fact_measurements", _RAW_CLEAN), ["property_id_y", "is_clean"], "v")
    return out.select("property_id_y", "is_clean", "n", *_rounded(_D))


_TWO = "SELECT source_domain = 'samples' AS is_first, y_si AS v FROM fact_measurements WHERE property_id_y = 16 AND abs(y_si) < 1e300"


@query(
    f"""WITH r AS (SELECT v, sum(CASE WHEN is_first THEN 1 ELSE 0 END) AS a, sum(CASE WHEN is_first THEN 0 ELSE 1 END) AS b FROM ({_TWO}) GROUP BY 1),
     d AS (SELECT max(abs(ca / na - cb / nb)) AS distance, any_value(na) AS n1, any_value(nb) AS n2 FROM (SELECT sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM r WINDOW w AS (ORDER BY v)))
     SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(distance, 9) AS distance, round(greatest(0, least(1, 2 * list_sum([(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2e0 * k * k * distance * distance * n1 * n2 / (n1 + n2)) for k in range(1, 101)]))), 9) AS p_value FROM d"""
)
def ks_two_sample(spark, sf_dir):
    rows = _view(spark, sf_dir, "fact_measurements", _TWO)
    return stats.ks_two_sample(rows, "v", F.col("is_first")).select("n1", "n2", F.round("distance", 9).alias("distance"), F.round("p_value", 9).alias("p_value"))


def _bit(i: int) -> str:
    return f"count(*) FILTER ((anomaly_flags >> {i}) & 1 = 1)"


@query(
    f"""SELECT count(*) AS n_total, {_bit(11)} AS n_algebraic, {_bit(6)} AS n_seebeck_bound, {_bit(7)} AS n_sigma_bound, {_bit(8)} AS n_kappa_bound, {_bit(0)} AS n_wf, {_bit(1)} AS n_crosscheck, {_bit(12)} AS n_temperature,
        count(*) FILTER (audit_tier = 4) AS n_rejected, count(*) FILTER (audit_tier = 4) / CAST(count(*) AS DOUBLE) AS rejection_rate FROM ({_BRANCHES})"""
)
def pipeline_counters(spark, sf_dir):
    return stats.pipeline_counters(branch_audit(spark, sf_dir))


@query(f"SELECT count(*) AS n_states, count(s_si) AS n_s, count(sigma_si) AS n_sigma, count(kappa_si) AS n_kappa, count(*) FILTER (s_si IS NOT NULL AND sigma_si IS NOT NULL AND kappa_si IS NOT NULL) AS n_complete, count(*) FILTER (audit_tier = 1) AS n_tier_a, count(*) FILTER (zt_computed BETWEEN 0 AND 4) AS n_zt_ok FROM ({_AUDITED})")
def coverage_funnel(spark, sf_dir):
    return stats.funnel(audited(spark, sf_dir))


@query(
    f"""WITH c AS (SELECT s_si, sigma_si, kappa_si, t_bin_k FROM ({_AUDITED}) WHERE audit_tier < 4) SELECT a, b, n, round(r, 8) AS r FROM (SELECT count(*) AS n, unnest([{", ".join("{'a': '%s', 'b': '%s', 'r': corr(%s, %s)}" % (a, b, a, b) for i, a in enumerate(("s_si", "sigma_si", "kappa_si", "t_bin_k")) for b in ("s_si", "sigma_si", "kappa_si", "t_bin_k")[i:])}], recursive := true) FROM c)"""
)
def correlation_matrix(spark, sf_dir):
    return stats.correlation_matrix(audited(spark, sf_dir).filter("audit_tier < 4"), ["s_si", "sigma_si", "kappa_si", "t_bin_k"]).withColumn("r", F.round("r", 8))


_TIERED = f"SELECT audit_tier, unnest(['s_uv', 'sigma_smm', 'kappa_si', 't_bin_k', 'zt_computed']) AS property, unnest([s_si * 1e6, sigma_si * 1e-3, kappa_si, t_bin_k, zt_computed]) AS v FROM ({_AUDITED})"


@query(_describe_sql(_TIERED, "audit_tier, property", "v"))
def descriptive_by_tier(spark, sf_dir):
    scaled = audited(spark, sf_dir).withColumns({"s_uv": F.col("s_si") * 1e6, "sigma_smm": F.col("sigma_si") * 1e-3})
    return stats.describe_by_tier(scaled, ["s_uv", "sigma_smm", "kappa_si", "t_bin_k", "zt_computed"]).select("audit_tier", "property", "n", *_rounded(_D))


@query(
    f"""SELECT n_states, n_whr, round(1e2 * n_good / n_states, 9) AS pct_good, round(median_zt, 8) AS median_zt, round(p90_zt, 8) AS p90_zt, round(mae, 8) AS mae FROM (SELECT count(*) AS n_states, count(*) FILTER (t_bin_k BETWEEN 323 AND 773) AS n_whr, count(*) FILTER (z >= 0.8) AS n_good,
        quantile_cont(z, 0.5) AS median_zt, quantile_cont(z, 0.9) AS p90_zt, avg(abs(z - zt_reported)) AS mae FROM (SELECT *, s_si*s_si*sigma_si*t_bin_k/kappa_si AS z FROM ({_PIVOT}) WHERE s_si IS NOT NULL AND sigma_si > 0 AND kappa_si > 0) WHERE z BETWEEN 0 AND 20)"""
)
def golden_triplets(spark, sf_dir):
    p = states.pivot_states(temperature_facts(spark, sf_dir)).filter("s_si IS NOT NULL AND sigma_si > 0 AND kappa_si > 0")
    z = p.withColumn("z", physics.zt(F.col("s_si"), F.col("sigma_si"), F.col("kappa_si"), F.col("t_bin_k"))).filter("z BETWEEN 0 AND 20")
    one = z.agg(F.count(F.lit(1)).alias("n_states"), F.count_if(F.col("t_bin_k").between(323, 773)).alias("n_whr"), F.count_if(F.col("z") >= 0.8).alias("n_good"), F.percentile("z", F.lit(0.5)).alias("median_zt"), F.percentile("z", F.lit(0.9)).alias("p90_zt"), F.avg(F.abs(F.col("z") - F.col("zt_reported"))).alias("mae"))
    return one.select("n_states", "n_whr", F.round(F.try_divide(100.0 * F.col("n_good"), F.col("n_states")), 9).alias("pct_good"), *_rounded({"median_zt": 8, "p90_zt": 8, "mae": 8}))


@query("SELECT property_id_y, CAST(least(floor((x_si - 50) / (145e1 / 60)), 59) AS INTEGER) AS bin, count(*) AS n FROM fact_measurements WHERE property_id_x = 1 AND x_si BETWEEN 50 AND 1500 GROUP BY 1, 2")
def temperature_histogram(spark, sf_dir):
    return stats.histogram(temperature_facts(spark, sf_dir), ["property_id_y"], "x_si", 50.0, 1500.0, 60)


@query(f"SELECT CAST(least(floor((s * 1e6 - -500) / 50), 19) AS INTEGER) AS x_bin, CAST(least(floor(kappa / 5e-1), 19) AS INTEGER) AS y_bin, count(*) AS n FROM ({_GRID}) WHERE s * 1e6 BETWEEN -500 AND 500 AND kappa BETWEEN 0 AND 10 GROUP BY 1, 2")
def seebeck_kappa_grid(spark, sf_dir):
    return stats.histogram2d(grid_states(spark, sf_dir).withColumn("s_uv", F.col("s") * 1e6), "s_uv", "kappa", (-500.0, 500.0), (0.0, 10.0), 20)


@query(f"SELECT count(*) AS n_compared, count(*) FILTER ((anomaly_flags & 2) <> 0) AS n_mismatch, round(1e2 * count(*) FILTER ((anomaly_flags & 2) <> 0) / count(*), 9) AS pct_mismatch FROM ({_AUDITED}) WHERE zt_error IS NOT NULL")
def zt_mismatch_share(spark, sf_dir):
    one = audited(spark, sf_dir).filter("zt_error IS NOT NULL").agg(F.count(F.lit(1)).alias("n_compared"), F.count_if(physics.has_flag(F.col("anomaly_flags"), "ZT_CROSSCHECK_FAIL")).alias("n_mismatch"))
    return one.withColumn("pct_mismatch", F.round(F.try_divide(100.0 * F.col("n_mismatch"), F.col("n_compared")), 9))


@query(f"SELECT sample_id, paper_id, t_bin_k, round(zt_error, 6) AS zt_error FROM ({_AUDITED}) WHERE zt_error IS NOT NULL ORDER BY zt_error DESC, sample_id, paper_id, t_bin_k LIMIT 3")
def worst_conflicts(spark, sf_dir):
    rows = audited(spark, sf_dir).filter("zt_error IS NOT NULL")
    return rows.orderBy(F.desc("zt_error"), "sample_id", "paper_id", "t_bin_k").limit(3).select("sample_id", "paper_id", "t_bin_k", F.round("zt_error", 6).alias("zt_error"))


# ---- joins with dimensions ------------------------------------------------------------------------------------------

_SAMPLE1 = "SELECT * FROM dim_samples QUALIFY row_number() OVER (PARTITION BY sample_id, paper_id ORDER BY row_id) = 1"
_PAPER1 = "SELECT paper_id, pub_year FROM dim_papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY ingested_at, title, pub_year) = 1"


def first_samples(spark, sf_dir, *columns: str) -> DataFrame:
    s = table(spark, sf_dir, "dim_samples").select("sample_id", "paper_id", "row_id", *columns)
    return clean.keep_first(s, ["sample_id", "paper_id"], ["row_id"])


def first_papers(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "dim_papers").select("paper_id", "pub_year", "ingested_at", "title")
    return clean.keep_first(p, ["paper_id"], ["ingested_at", "title", "pub_year"]).select("paper_id", "pub_year")


@query(f"SELECT a.sample_id, a.paper_id, a.t_bin_k, a.audit_tier, s.composition, p.pub_year FROM ({_AUDITED}) a LEFT JOIN ({_SAMPLE1}) s ON s.sample_id = a.sample_id AND s.paper_id = a.paper_id LEFT JOIN ({_PAPER1}) p ON p.paper_id = a.paper_id")
def states_enriched(spark, sf_dir):
    a = audited(spark, sf_dir).select("sample_id", "paper_id", "t_bin_k", "audit_tier")
    return a.join(first_samples(spark, sf_dir, "composition").drop("row_id"), ["sample_id", "paper_id"], "left").join(first_papers(spark, sf_dir), "paper_id", "left").select("sample_id", "paper_id", "t_bin_k", "audit_tier", "composition", "pub_year")


@query(f"SELECT f.property_id_y, count(*) AS n_rows, count(DISTINCT measurement_id) AS n_points FROM fact_measurements f JOIN ({_AUDITED}) a ON a.sample_id = f.sample_id AND a.paper_id = f.paper_id WHERE a.audit_tier IN (1, 2, 3) GROUP BY 1")
def filtered_measurements(spark, sf_dir):
    """The fan-out variant counted without fanning out: a point occurs once per surviving state of its sample."""
    keys = ["sample_id", "paper_id"]
    kept = audited(spark, sf_dir).filter("audit_tier < 4").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_states"))
    return facts(spark, sf_dir).select("property_id_y", *keys).join(kept, keys).groupBy("property_id_y").agg(F.sum("n_states").alias("n_rows"), F.count(F.lit(1)).alias("n_points"))


@query(f"SELECT measurement_id FROM fact_measurements f WHERE EXISTS (SELECT 1 FROM ({_AUDITED}) a WHERE a.sample_id = f.sample_id AND a.paper_id = f.paper_id AND a.audit_tier IN (1, 2))")
def filtered_measurements_semi(spark, sf_dir):
    kept = states.clean_states(audited(spark, sf_dir)).select("sample_id", "paper_id").distinct()
    return facts(spark, sf_dir).select("measurement_id", "sample_id", "paper_id").join(kept, ["sample_id", "paper_id"], "left_semi").select("measurement_id")


@query("SELECT p.property_id, p.propertyname, count(*) AS n_points, count(DISTINCT m.paper_id) AS n_papers FROM fact_measurements m JOIN dim_properties p ON p.property_id = m.property_id_y GROUP BY 1, 2")
def property_coverage(spark, sf_dir):
    counted = facts(spark, sf_dir).groupBy("property_id_y").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("paper_id").alias("n_papers"))
    p = table(spark, sf_dir, "dim_properties").select("property_id", "propertyname")
    return counted.join(p, F.col("property_id_y") == F.col("property_id")).select("property_id", "propertyname", F.col("n").alias("n_points"), "n_papers")


@query(f"SELECT pub_year, n, CASE WHEN count(n) OVER w = 5 THEN avg(n) OVER w END AS rolling_mean FROM (SELECT pub_year, count(DISTINCT paper_id) AS n FROM dim_papers WHERE pub_year BETWEEN 1980 AND 2030 GROUP BY 1) WINDOW w AS (ORDER BY pub_year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def year_counts_rolling(spark, sf_dir):
    from pyspark.sql import Window

    years = table(spark, sf_dir, "dim_papers").filter(F.col("pub_year").between(1980, 2030)).groupBy("pub_year").agg(F.countDistinct("paper_id").alias("n"))
    w = Window.orderBy("pub_year").rowsBetween(-2, 2)  # at most 51 years
    return years.withColumn("rolling_mean", F.when(F.count("n").over(w) == 5, F.avg("n").over(w)))


@query("SELECT coalesce(nullif(trim(material_family), ''), 'Unclassified') AS family, count(DISTINCT (sample_id, paper_id)) AS n_samples FROM dim_samples GROUP BY 1 ORDER BY n_samples DESC, family LIMIT 20")
def family_counts(spark, sf_dir):
    f = table(spark, sf_dir, "dim_samples").select(text.family_label(F.col("material_family")).alias("family"), "sample_id", "paper_id").distinct()
    return f.groupBy("family").agg(F.count(F.lit(1)).alias("n_samples")).orderBy(F.desc("n_samples"), "family").limit(20)


@query("SELECT coalesce(nullif(list_aggregate(list_sort(list_distinct(regexp_extract_all(coalesce(composition, ''), '[A-Z][a-z]?')))[1:3], 'string_agg', '-'), ''), 'Unknown') AS system, count(*) AS n FROM dim_samples GROUP BY 1 ORDER BY n DESC, system LIMIT 20")
def element_systems(spark, sf_dir):
    s = table(spark, sf_dir, "dim_samples").groupBy(text.element_system(F.col("composition")).alias("system")).agg(F.count(F.lit(1)).alias("n"))
    return s.orderBy(F.desc("n"), "system").limit(20)


_ANY = lambda words, c: " OR ".join(f"contains({c}, '{w}')" for w in words)
_TEXT = "lower(concat_ws(' ', fabrication_process, data_type, thermal_measurement, electrical_measurement, samplename))"


@query(f"SELECT row_id, CASE WHEN {_ANY(text.COMPUTATIONAL, _TEXT)} THEN 'Computational' WHEN {_ANY(text.EXPERIMENTAL, _TEXT)} THEN 'Experimental' ELSE 'Unknown' END AS experiment_class FROM dim_samples")
def experiment_class(spark, sf_dir):
    fields = ("fabrication_process", "data_type", "thermal_measurement", "electrical_measurement", "samplename")
    return table(spark, sf_dir, "dim_samples").select("row_id", text.experiment_class([F.col(f) for f in fields]).alias("experiment_class"))


@query("SELECT row_id, coalesce(trim(CASE WHEN json_valid(sampleinfo_json) THEN json_extract_string(sampleinfo_json, '$.MaterialFamily.category') END), '') AS family, coalesce(trim(CASE WHEN json_valid(sampleinfo_json) THEN json_extract_string(sampleinfo_json, '$.DataType.category') END), '') AS data_kind FROM dim_samples")
def sampleinfo_extract(spark, sf_dir):
    j = F.col("sampleinfo_json")
    return table(spark, sf_dir, "dim_samples").select("row_id", text.sampleinfo_category(j, "MaterialFamily").alias("family"), text.sampleinfo_category(j, "DataType").alias("data_kind"))


# ---- tables, curves, files ------------------------------------------------------------------------------------------

_CSV = """SELECT composition, coalesce(sampleid, 'unknown') AS sampleid, temperature AS t, arg_max(seebeck, row_id) FILTER (seebeck IS NOT NULL) AS s, arg_max(electrical_conductivity, row_id) FILTER (electrical_conductivity IS NOT NULL) AS sigma,
 arg_max(thermal_conductivity, row_id) FILTER (thermal_conductivity IS NOT NULL) AS kappa FROM interpolated_states WHERE temperature IS NOT NULL GROUP BY ALL"""


@query(
    f"""SELECT count(*) AS n_states, count(*) FILTER (complete) AS n_complete, count(z) AS n_valid, count(*) FILTER (complete) - count(z) AS n_rejected, round(avg(z), 9) AS mean_zt, min(z) AS min_zt, max(z) AS max_zt FROM (SELECT complete, CASE WHEN z BETWEEN 0 AND 5 THEN z END AS z FROM (
        SELECT s IS NOT NULL AND sigma IS NOT NULL AND kappa IS NOT NULL AS complete, CASE WHEN t > 0 AND kappa > 0 AND sigma > 0 AND abs(s) <= 5e-2 AND sigma <= 1e8 AND kappa <= 5000 THEN s*s*sigma*CAST(t AS DOUBLE)/kappa END AS z FROM ({_CSV})))"""
)
def csv_state_report(spark, sf_dir):
    g = table(spark, sf_dir, "interpolated_states").select("row_id", "composition", "sampleid", "temperature", "seebeck", F.col("electrical_conductivity").alias("electrical conductivity"), F.col("thermal_conductivity").alias("thermal conductivity"))
    return states.csv_report(tabular.csv_states(g, "row_id")).withColumn("mean_zt", F.round("mean_zt", 9))


@query(
    f"""SELECT sample_id, paper_id, line_no, t, audit_tier, anomaly_flags, CASE WHEN (anomaly_flags & 2048) <> 0 THEN 'gate_1' WHEN (anomaly_flags & 1) <> 0 THEN 'gate_2' WHEN (anomaly_flags & 2) <> 0 THEN 'gate_3' ELSE 'temperature' END AS rejection_stage,
        concat_ws('|', {", ".join(f"CASE WHEN (anomaly_flags >> {i}) & 1 = 1 THEN '{n}' END" for i, n in enumerate(K.FLAGS))}) AS reasons FROM ({_BRANCHES}) WHERE audit_tier = 4 OR anomaly_flags <> 0"""
)
def bad_records(spark, sf_dir):
    return writers.bad_records(branch_audit(spark, sf_dir)).select("sample_id", "paper_id", "line_no", "t", "audit_tier", "anomaly_flags", "rejection_stage", "reasons")


@query(
    """SELECT CAST(row_id AS BIGINT) AS sample_id, coalesce(composition, 'unknown') AS composition, CAST(coalesce(paperid, 0) AS BIGINT) AS paper_id, audit_tier AS confidence_tier, anomaly_flags, zt_computed, '' AS unit_x, 0e0 AS x FROM ("""
    + _audit_sql(_GRID)
    + ")"
)
def publication_dataset(spark, sf_dir):
    """Audit and defaults only, without duplicate bits; the whole dataset is publication_dataset_full."""
    a = physics.audit(grid_states(spark, sf_dir)).withColumnsRenamed({"row_id": "sample_id", "paperid": "paper_id"})
    return writers.publication_rows(a).select("sample_id", "composition", "paper_id", "confidence_tier", "anomaly_flags", "zt_computed", "unit_x", "x")


@query(
    f"""SELECT CAST(row_id AS BIGINT) AS sample_id, coalesce(composition, 'unknown') AS composition, CAST(coalesce(paperid, 0) AS BIGINT) AS paper_id, '' AS property_x, '' AS property_y, '' AS unit_x, '' AS unit_y, 0e0 AS x, 0e0 AS y,
        audit_tier AS confidence_tier, anomaly_flags | dup_flag AS anomaly_flags, zt_computed, kappa_lattice, lorenz_number, zt_error AS zt_cross_check_error FROM ({_audit_sql(_GRID)}) JOIN ({ORACLE["dedup_flags_row"]}) USING (row_id)"""
)
def publication_dataset_full(spark, sf_dir):
    """The whole publication pipeline over the table of states: audit, duplicate bits, and all 15 fields."""
    rows = table(spark, sf_dir, "interpolated_states").withColumnsRenamed({"row_id": "sample_id", "paperid": "paper_id"})
    return pipelines.publication_dataset(rows, "sample_id")


_LISTS = "SELECT o_orderkey AS id, concat('[', CAST(o_orderkey % 7 AS STRING), ', ', CAST(o_custkey % 5 AS STRING), ']') AS xs, CASE WHEN o_orderkey % 10 = 0 THEN '[1' WHEN o_orderkey % 9 = 0 THEN '[1]' ELSE concat('[', CAST(o_custkey % 3 AS STRING), ', 4]') END AS ys FROM orders"


@query(
    """SELECT o_orderkey AS id, i AS pos, CASE i WHEN 0 THEN CAST(o_orderkey % 7 AS DOUBLE) ELSE CAST(o_custkey % 5 AS DOUBLE) END AS x, CASE i WHEN 0 THEN CAST(o_custkey % 3 AS DOUBLE) ELSE 4e0 END AS y FROM orders, (VALUES (0), (1)) v(i) WHERE o_orderkey % 10 <> 0 AND o_orderkey % 9 <> 0"""
)
def curve_explode(spark, sf_dir):
    lists = _view(spark, sf_dir, "orders", _LISTS).withColumns({"xs": text.parse_list(F.col("xs")), "ys": text.parse_list(F.col("ys"))})
    whole = lists.filter(F.size("xs") == F.size("ys"))
    return whole.select("id", F.posexplode(F.arrays_zip("xs", "ys")).alias("pos", "p")).select("id", "pos", F.col("p.xs").alias("x"), F.col("p.ys").alias("y"))


_ROLE = "CASE property_id_y WHEN 2 THEN 's' WHEN 3 THEN 'sigma' WHEN 4 THEN 'kappa' WHEN 16 THEN 'zt' END"


@query(
    f"""WITH k AS (SELECT sample_id, paper_id, {_ROLE} AS role, x_si AS t, avg(y_si) AS y FROM fact_measurements WHERE property_id_x = 1 AND property_id_y IN (2, 3, 4, 16) AND x_si > 0 AND isfinite(x_si) AND isfinite(y_si) GROUP BY ALL),
     seg AS (SELECT *, lead(t) OVER w AS t2, lead(y) OVER w AS y2 FROM k WINDOW w AS (PARTITION BY sample_id, paper_id, role ORDER BY t)),
     span AS (SELECT sample_id, paper_id, role, min(t) AS a, max(t) AS b, count(*) AS n FROM k GROUP BY ALL HAVING count(*) >= 2),
     c AS (SELECT sample_id, paper_id, max(a) AS low, min(b) AS high FROM span GROUP BY ALL HAVING count(*) = 4),
     n AS (SELECT *, CAST(CASE WHEN high >= low THEN floor((high - low) / 10) + 1 ELSE 0 END AS INTEGER) AS n_grid FROM c),
     g AS (SELECT sample_id, paper_id, n_grid, low + i * 1e1 AS t FROM (SELECT *, unnest(range(0, n_grid)) AS i FROM n WHERE n_grid >= 3)),
     v AS (SELECT g.sample_id, g.paper_id, g.t, role, CASE WHEN seg.t = g.t OR t2 IS NULL THEN y ELSE y + (y2 - y) * ((g.t - seg.t) / (t2 - seg.t)) END AS v FROM g JOIN seg ON seg.sample_id = g.sample_id AND seg.paper_id = g.paper_id AND seg.t <= g.t AND (seg.t2 > g.t OR seg.t2 IS NULL)),
     w AS (SELECT sample_id, paper_id, t, max(v) FILTER (role = 's') AS s, max(v) FILTER (role = 'sigma') AS sigma, max(v) FILTER (role = 'kappa') AS kappa, max(v) FILTER (role = 'zt') AS zt FROM v GROUP BY ALL),
     e AS (SELECT sample_id, paper_id, CAST(count(*) AS INTEGER) AS n_grid, sum(abs(s*s*sigma*t/kappa - zt) / greatest(abs(zt), 1e-6)) / count(*) AS me FROM w WHERE kappa <> 0 OR kappa = 0 GROUP BY ALL)
     SELECT sample_id, paper_id, n_grid, round(me, 6) AS mean_error, me <= 1e-1 AS passed, CAST(CASE WHEN me <= 1e-1 THEN 0 ELSE 2 END AS INTEGER) AS anomaly_flags FROM e UNION ALL SELECT sample_id, paper_id, n_grid, NULL, false, 32 FROM n WHERE n_grid < 3"""
)
def zt_crosscheck_linear(spark, sf_dir):
    out = curves.crosscheck_linear(temperature_facts(spark, sf_dir))
    return out.select("sample_id", "paper_id", "n_grid", F.round("mean_error", 6).alias("mean_error"), "passed", "anomaly_flags")


_END = "CASE WHEN {near} * {far} <= 0 THEN {near} ELSE greatest(least(0e0, 2 * {near}), least(greatest(0e0, 2 * {near}), (2 * {near} + {far}) / 3)) END"
_SCALE = "CASE WHEN {d} = 0 THEN 0e0 WHEN sqrt(pow({l} / {d}, 2) + pow({r} / {d}, 2)) > 3 THEN 3 * {m} / sqrt(pow({l} / {d}, 2) + pow({r} / {d}, 2)) ELSE {m} END"


def _scaled(left: str, right: str, m: str) -> str:
    return _SCALE.format(d="d", l=left, r=right, m=m)


@query(
    f"""WITH RECURSIVE k AS (SELECT sample_id, paper_id, {_ROLE} AS role, x_si AS t, avg(y_si) AS y FROM fact_measurements WHERE property_id_x = 1 AND property_id_y IN (2, 3, 4, 16) AND x_si > 0 AND isfinite(x_si) AND isfinite(y_si) GROUP BY ALL),
     span AS (SELECT sample_id, paper_id, role, min(t) AS a, max(t) AS b, count(*) AS n FROM k GROUP BY ALL HAVING count(*) >= 2),
     c AS (SELECT sample_id, paper_id, max(a) AS low, min(b) AS high FROM span GROUP BY ALL HAVING count(*) = 4),
     n AS (SELECT *, CAST(CASE WHEN high >= low THEN floor((high - low) / 10) + 1 ELSE 0 END AS INTEGER) AS n_grid FROM c),
     s1 AS (SELECT k.*, row_number() OVER w - 1 AS i, lead(t) OVER w AS t2, lead(y) OVER w AS y2, lead(t) OVER w - t AS h, (lead(y) OVER w - y) / (lead(t) OVER w - t) AS d FROM k JOIN c USING (sample_id, paper_id) WINDOW w AS (PARTITION BY sample_id, paper_id, role ORDER BY t)),
     s2 AS (SELECT *, lag(d) OVER w AS d0, lag(h) OVER w AS h0, lead(d) OVER w AS dn, lag(d, 2) OVER w AS dl FROM s1 WINDOW w AS (PARTITION BY sample_id, paper_id, role ORDER BY i)),
     s3 AS (SELECT *, CASE WHEN i = 0 AND dn IS NULL THEN d WHEN i = 0 THEN {_END.format(near="d", far="dn")} WHEN d IS NULL AND dl IS NULL THEN d0 WHEN d IS NULL THEN {_END.format(near="d0", far="dl")}
            WHEN d0 * d > 0 THEN (3 * h + 3 * h0) / ((2 * h + h0) / d0 + (h + 2 * h0) / d) ELSE 0e0 END AS m FROM s2),
     s4 AS (SELECT *, lead(m) OVER (PARTITION BY sample_id, paper_id, role ORDER BY i) AS mr FROM s3),
     r AS (SELECT sample_id, paper_id, role, i, {_scaled("m", "mr", "m")} AS ml, {_scaled("m", "mr", "mr")} AS carry FROM s4 WHERE i = 0
           UNION ALL SELECT s4.sample_id, s4.paper_id, s4.role, s4.i, {_scaled("carry", "mr", "carry")}, {_scaled("carry", "mr", "mr")} FROM r JOIN s4 ON s4.sample_id = r.sample_id AND s4.paper_id = r.paper_id AND s4.role = r.role AND s4.i = r.i + 1 WHERE s4.d IS NOT NULL),
     f AS (SELECT s4.*, r.ml, coalesce(r2.ml, r.carry) AS mf FROM s4 JOIN r USING (sample_id, paper_id, role, i) LEFT JOIN r r2 ON r2.sample_id = s4.sample_id AND r2.paper_id = s4.paper_id AND r2.role = s4.role AND r2.i = s4.i + 1),
     g AS (SELECT sample_id, paper_id, n_grid, least(low + i * 1e1, high) AS t FROM (SELECT *, unnest(range(0, n_grid)) AS i FROM n WHERE n_grid >= 3)),
     u AS (SELECT g.sample_id, g.paper_id, g.t, role, (g.t - f.t) / h AS u, y, y2 - y AS rise, ml * h AS a, mf * h AS b FROM g JOIN f ON f.sample_id = g.sample_id AND f.paper_id = g.paper_id AND f.t <= g.t AND (f.t2 > g.t OR (f.t2 = g.t AND f.dn IS NULL))),
     v AS (SELECT *, y + u * (a + u * ((3 * rise - 2 * a - b) + u * (a + b - 2 * rise))) AS v FROM u),
     w AS (SELECT sample_id, paper_id, t, max(v) FILTER (role = 's') AS s, max(v) FILTER (role = 'sigma') AS sigma, max(v) FILTER (role = 'kappa') AS kappa, max(v) FILTER (role = 'zt') AS zt FROM v GROUP BY ALL),
     e AS (SELECT sample_id, paper_id, CAST(count(*) AS INTEGER) AS n_grid, coalesce(sum(CASE WHEN kappa <> 0 THEN abs(s*s*sigma*t/kappa - zt) / greatest(abs(zt), 1e-6) END), 0) / count(*) AS me FROM w GROUP BY ALL)
     SELECT sample_id, paper_id, n_grid, round(me, 6) AS mean_error, me <= 1e-1 AS passed, CAST(CASE WHEN me <= 1e-1 THEN 0 ELSE 2 END AS INTEGER) AS anomaly_flags FROM e UNION ALL SELECT sample_id, paper_id, n_grid, NULL, false, 32 FROM n WHERE n_grid < 3"""
)
def zt_crosscheck_pchip(spark, sf_dir):
    out = curves.crosscheck_pchip(temperature_facts(spark, sf_dir))
    return out.select("sample_id", "paper_id", "n_grid", F.round("mean_error", 6).alias("mean_error"), "passed", "anomaly_flags")


@query(f"SELECT row_id, t, s FROM ({_GRID}) ORDER BY md5(concat('42|', CAST(row_id AS VARCHAR))), row_id LIMIT 5000")
def reservoir_sample(spark, sf_dir):
    """A fixed-size uniform sample of states: the operator itself."""
    return stats.reservoir(grid_states(spark, sf_dir), 5_000, "row_id").select("row_id", "t", "s")


_TEXTS = ("composition", "data_type", "deleted_at", "electrical_measurement", "fabrication_process", "form", "grain_size", "ingested_at", "material_family", "paper_id", "relative_density", "row_id", "sample_id", "sampleinfo_json", "samplename", "thermal_measurement")
_FIGURE_TEXTS = ("caption", "deleted_at", "figure_id", "figurename", "ingested_at", "paper_id", "property_id_x", "property_id_y", "row_id")


def _digest_sql(name: str, columns: tuple[str, ...]) -> str:
    """The digest of a table in SQL: every row as text over its sorted columns, hashed, and combined by count and sums."""
    row = ", ".join(f"concat('{c}=', coalesce(CAST({c} AS VARCHAR), 'null'))" for c in columns)
    sums = ", ".join(f"CAST(sum(CAST(concat('0x', substr(h, {1 + 8 * i}, 8)) AS BIGINT)) AS VARCHAR)" for i in range(8))
    return f"SELECT '{name}' AS table_name, count(*) AS n_rows, sha256(concat_ws('|', count(*), {sums})) AS digest FROM (SELECT sha256(concat_ws(chr(31), {row})) AS h FROM {name})"


@query(_digest_sql("dim_samples", _TEXTS) + " UNION ALL " + _digest_sql("dim_figures", _FIGURE_TEXTS))
def canonical_hash(spark, sf_dir):
    one = lambda n: stats.canonical_hash(table(spark, sf_dir, n)).select(F.lit(n).alias("table_name"), "n_rows", "digest")
    return one("dim_samples").unionByName(one("dim_figures"))


#: The measurements by file, which is what a corpus of files made of them holds; a file with a point that lacks an id or a number is refused.
_BY_FILE = """SELECT *, bool_or(paper_id IS NULL OR paper_id < 0 OR sample_id IS NULL OR sample_id < 0 OR figure_id IS NULL OR figure_id < 0 OR property_id_x IS NULL OR property_id_x < 0 OR property_id_y IS NULL OR property_id_y < 0 OR x_si IS NULL OR y_si IS NULL)
  OVER (PARTITION BY coalesce(source_file, concat('m', measurement_id))) AS refused, coalesce(source_file, concat('m', measurement_id)) AS file_name FROM fact_measurements"""


def _scanned_corpus(spark, sf_dir):
    """The measurements written as one JSON file per source file, which lists only its figures of even number, and scanned."""
    name = F.coalesce("source_file", F.concat(F.lit("m"), F.col("measurement_id").cast("string")))
    ids = (("paperid", "paper_id"), ("sampleid", "sample_id"), ("figureid", "figure_id"), ("propertyid_x", "property_id_x"), ("propertyid_y", "property_id_y"), ("x", "x_si"), ("y", "y_si"))
    figure = F.when(F.col("figure_id") % 2 == 0, F.struct(F.col("figure_id").alias("figureid")))
    by = facts(spark, sf_dir).groupBy(name.alias("name")).agg(F.min("measurement_id").alias("id"), F.to_json(F.struct(F.collect_set(figure).alias("figure"), F.collect_list(F.struct(*(F.col(c).alias(a) for a, c in ids))).alias("rawdata"))).alias("text"))
    root = scratch_path(spark, "facts-corpus")
    writers.write_json_files(by.select("id", "text"), root)
    return written(corpus.scan_domain(spark, root, "samples"), "scan")


@query(f"SELECT property_id_y, count(*) AS n_points, count(*) FILTER (figure_id % 2 = 1) AS n_mismatch, min(x_si) AS least_x, max(x_si) AS largest_x FROM ({_BY_FILE}) WHERE NOT refused AND {_KEPT} GROUP BY 1")
def scan_measurements(spark, sf_dir):
    """The points of a scanned corpus per property, with those whose figure the file does not list."""
    points = corpus.measurements(_scanned_corpus(spark, sf_dir))
    return points.groupBy("property_id_y").agg(F.count(F.lit(1)).alias("n_points"), F.count_if(physics.has_flag(F.col("anomaly_flags"), "FIGUREID_MISMATCH")).alias("n_mismatch"), F.min("x").alias("least_x"), F.max("x").alias("largest_x"))


@query(
    f"""SELECT count(DISTINCT file_name) AS files_seen, count(DISTINCT file_name) FILTER (refused) AS files_failed, count(*) FILTER (NOT refused) AS n_rawdata, count(*) FILTER (NOT refused AND {_KEPT}) AS n_kept,
        count(*) FILTER (NOT refused AND NOT ({_KEPT})) AS n_rejected, count(*) FILTER (NOT refused AND {_KEPT} AND figure_id % 2 = 1) AS n_figure_mismatch FROM ({_BY_FILE})"""
)
def scan_counters(spark, sf_dir):
    """The counters of a scanned corpus."""
    return corpus.scan_summary(_scanned_corpus(spark, sf_dir)).select("files_seen", "files_failed", "n_rawdata", "n_kept", "n_rejected", "n_figure_mismatch")


@query()
def two_shape_points(spark, sf_dir):
    raw = table(spark, sf_dir, "raw_files").select("file_id", "payload")
    return corpus.two_shape_points(raw).select("file_id", "position", "sample_id", "x", "y")


@query()
def scan_json_corpus(spark, sf_dir):
    """Write every raw payload as a JSON file of its own, scan the sharded corpus, and count files, records and the points that measurements gives."""
    root = scratch_path(spark, "corpus")
    writers.write_json_files(table(spark, sf_dir, "raw_files").select(F.col("file_id").cast("long"), "payload"), root)
    files = written(corpus.scan_domain(spark, root, "samples"), "scan")
    mismatch = F.count_if(physics.has_flag(F.col("anomaly_flags"), "FIGUREID_MISMATCH"))
    points = corpus.measurements(files).groupBy("source_domain").agg(F.count(F.lit(1)).alias("n_points"), mismatch.alias("n_points_mismatch"))
    missing = files.groupBy("source_domain").agg(F.count_if(F.col("error") == "UNREADABLE").alias("files_unreadable"), F.count_if(F.col("error") == "FIELD_MISSING").alias("files_field_missing"))
    return corpus.scan_summary(files).join(missing, "source_domain").join(points, "source_domain", "left").fillna(0, ["n_points", "n_points_mismatch"])


@query("SELECT property_id_y, count(*) AS n FROM (SELECT DISTINCT paper_id, figure_id, sample_id, property_id_y, x_raw, y_raw FROM fact_measurements WHERE " + _KEPT + ") GROUP BY 1")
def stream_dedup_available_now(spark, sf_dir):
    """Stream the measurements in file batches, drop repeats exactly once over all batches, and count what was written.

    State older than ten years before the newest digitising time is given up; no repeats of a point lie further apart.
    """
    keys = ["paper_id", "figure_id", "sample_id", "property_id_y", "x_raw", "y_raw"]
    batch = facts(spark, sf_dir)
    source = scratch_path(spark, "stream-in")
    batch.select("measurement_id", *keys, "x_si", "y_si", F.col("digitised_at").cast("timestamp").alias("digitised_at")).write.parquet(source)
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint")
    stream = ingest.clean_points(ingest.stream_files(spark, source, spark.read.parquet(source).schema))
    stream = ingest.dedup_stream(stream, keys, "digitised_at", "3650 days")
    ingest.run_available(stream, checkpoint, lambda df, _: df.write.mode("append").parquet(out))
    return spark.read.parquet(out).groupBy("property_id_y").agg(F.count(F.lit(1)).alias("n"))


# ---- record pipeline ------------------------------------------------------------------------------------------------

_OK = "coalesce(isfinite(s) AND isfinite(sigma) AND isfinite(kappa) AND t > 0 AND sigma > 0 AND kappa > 0, false)"
_ZT_OK = f"CASE WHEN {_OK} AND abs(s) <= 1e-3 AND sigma <= 1e7 AND kappa <= 100 THEN CASE WHEN kappa/(sigma*t) BETWEEN 1e-9 AND 1e-7 AND s*s*sigma*t/kappa <= 4 THEN s*s*sigma*t/kappa END END"


@query(f"SELECT sample_id, count(*) AS n_points, count(*) - count(z) AS n_violations, count(*) = count(z) AS valid, round(avg(z), 9) + 0e0 AS mean_zt, max(z) AS max_zt FROM (SELECT sample_id, {_ZT_OK} AS z FROM ({_V_STATES})) GROUP BY 1")
def record_gate(spark, sf_dir):
    points = v_states(spark, sf_dir).withColumn("credibility_prior", F.lit(0.5))
    out = pipelines.score_records(points)
    return out.select("sample_id", "n_points", "n_violations", "valid", (F.round("mean_zt", 9) + 0.0).alias("mean_zt"), "max_zt")


#: Curves of two points per order with their provenance; some lists are broken or of another length.
_CURVES = """SELECT o_orderkey AS sample_id, '[300.0, 400.0]' AS temperature, CASE WHEN o_orderkey % 11 = 0 THEN '[1e-4' WHEN o_orderkey % 7 = 0 THEN '[1e-4]' ELSE '[0.0001, 0.0002]' END AS seebeck,
 concat('[', CAST(IF(o_custkey % 5 = 0, 1000, 100000) + o_custkey % 500 AS STRING), '.0, 200000.0]') AS electrical_conductivity, '[1.5, 2.5]' AS thermal_conductivity FROM orders"""
_RECORD_POINTS = """SELECT o.o_orderkey AS sample_id, concat('d', CAST(o.o_custkey AS VARCHAR)) AS doi, CASE WHEN c.c_custkey % 3 = 0 THEN 5e-1 ELSE (c.c_custkey % 10) / 10e0 END AS credibility_prior, position, CASE position WHEN 0 THEN 300e0 ELSE 400e0 END AS t,
 CASE position WHEN 0 THEN 1e-4 ELSE 2e-4 END AS s, CASE position WHEN 0 THEN CASE WHEN o.o_custkey % 5 = 0 THEN 1000e0 ELSE 100000e0 END + o.o_custkey % 500 ELSE 200000e0 END AS sigma, CASE position WHEN 0 THEN 1.5e0 ELSE 2.5e0 END AS kappa
 FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey, (VALUES (0), (1)) v(position) WHERE o.o_orderkey % 11 <> 0 AND o.o_orderkey % 7 <> 0"""


def _record_tables(spark, sf_dir):
    samples = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"), F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("doi"))
    key = F.col("c_custkey")
    papers = table(spark, sf_dir, "customer").select(F.concat(F.lit("d"), key.cast("string")).alias("doi"), F.when(key % 3 != 0, (key % 10) / F.lit(10.0)).alias("credibility_prior"))
    return _view(spark, sf_dir, "orders", _CURVES), samples, papers


@query(_RECORD_POINTS)
def provenance_join(spark, sf_dir):
    """Curves joined with samples and papers, one row per point: the good records."""
    return pipelines.record_points(*_record_tables(spark, sf_dir))[0]


@query("SELECT o_orderkey AS sample_id, 'LISTS_UNEQUAL' AS error_code FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 11 = 0 OR o_orderkey % 7 = 0")
def record_errors(spark, sf_dir):
    """The records whose lists cannot be read or differ in length, each on its own."""
    return pipelines.record_points(*_record_tables(spark, sf_dir))[1]


@query(
    f"""SELECT count(*) + any_value(bad) AS processed, count(*) FILTER (ok) AS inserted, count(*) FILTER (NOT ok) + any_value(bad) AS failed, CAST(sum(v) AS BIGINT) AS violations, round(coalesce(avg(m) FILTER (ok), 0), 9) AS mean_zt, round(coalesce(max(x) FILTER (ok), 0), 9) AS max_zt
        FROM (SELECT sample_id, count(z) = count(*) AS ok, count(*) - count(z) AS v, avg(z) AS m, max(z) AS x FROM (SELECT sample_id, {_ZT_OK} AS z FROM ({_RECORD_POINTS})) GROUP BY 1), (SELECT count(*) AS bad FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 11 = 0 OR o_orderkey % 7 = 0)"""
)
def record_pipeline(spark, sf_dir):
    """The counts of a whole run of the record pipeline."""
    r = pipelines.run_records(*_record_tables(spark, sf_dir))
    return spark.createDataFrame([(r.processed, r.inserted, r.failed, r.violations, round(r.mean_zt, 9), round(r.max_zt, 9))], "processed long, inserted long, failed long, violations long, mean_zt double, max_zt double")


@query(
    "SELECT field, count(*) AS n_missing FROM (SELECT unnest(["
    + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in ("paper_id", "sample_id", "figure_id", "property_id_x", "property_id_y", "x_si", "y_si", "source_domain", "source_file", "digitised_at"))
    + "]) AS field FROM fact_measurements) WHERE field IS NOT NULL GROUP BY 1"
)
def mandatory_fields(spark, sf_dir):
    names = ("paper_id", "sample_id", "figure_id", "property_id_x", "property_id_y", "x_si", "y_si", "source_domain", "source_file", "digitised_at")
    missing = F.explode(F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in names))))
    return facts(spark, sf_dir).select(missing.alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n_missing"))


@query("SELECT row_id, strftime(exported_at, '%Y-%m-%dT%H:%M:%SZ') AS exported_utc FROM interpolated_states")
def utc_timestamps(spark, sf_dir):
    return table(spark, sf_dir, "interpolated_states").select("row_id", F.date_format("exported_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("exported_utc"))


_MARKED = f"SELECT property_id_y, y_si AS v, c.ok IS NOT NULL AS is_clean FROM fact_measurements f LEFT JOIN (SELECT DISTINCT sample_id, paper_id, true AS ok FROM ({_AUDITED}) WHERE audit_tier IN (1, 2)) c ON c.sample_id = f.sample_id AND c.paper_id = f.paper_id WHERE property_id_y IN (2, 3, 4, 16) AND abs(y_si) < 1e300"


@query(f"SELECT property_id_y, is_clean, count(*) AS n, min(v) AS least, max(v) AS largest, round(avg(v) / max(v), 9) AS mean_of_largest FROM ({_MARKED}) GROUP BY 1, 2")
def before_and_after(spark, sf_dir):
    """The description of raw against clean points, from the pipeline."""
    d = pipelines.before_and_after(facts(spark, sf_dir))["description"]
    return d.select("property_id_y", "is_clean", "n", "least", "largest", F.round(F.col("mean") / F.col("largest"), 9).alias("mean_of_largest"))


@query(
    f"""WITH r AS (SELECT property_id_y, v, count(*) FILTER (is_clean) AS a, count(*) FILTER (NOT is_clean) AS b FROM ({_MARKED}) GROUP BY 1, 2)
     SELECT property_id_y, CAST(any_value(na) AS BIGINT) AS n1, CAST(any_value(nb) AS BIGINT) AS n2, round(max(abs(ca / na - cb / nb)), 9) AS distance
     FROM (SELECT property_id_y, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER p AS na, sum(b) OVER p AS nb FROM r WINDOW w AS (PARTITION BY property_id_y ORDER BY v), p AS (PARTITION BY property_id_y)) GROUP BY 1"""
)
def before_and_after_two_sample(spark, sf_dir):
    """The two-sample tests of raw against clean points, from the pipeline."""
    return pipelines.before_and_after(facts(spark, sf_dir))["two_sample"].select("property_id_y", "n1", "n2", F.round("distance", 9).alias("distance"))


@query(f"SELECT count(*) AS n_pairs, count(*) FILTER ((anomaly_flags & 2) <> 0) AS n_mismatch, round(avg(zt_computed - zt_reported), 9) AS bias, round(sqrt(avg(pow(zt_computed - zt_reported, 2))), 9) AS rmse FROM ({_AUDITED}) WHERE zt_reported > 0 AND zt_reported <= 10 AND zt_computed > 0 AND zt_computed <= 10")
def zt_pairs(spark, sf_dir):
    """Reported against computed zT where both are in (0, 10]."""
    both = audited(spark, sf_dir).filter("zt_reported > 0 AND zt_reported <= 10 AND zt_computed > 0 AND zt_computed <= 10")
    gap = F.col("zt_computed") - F.col("zt_reported")
    return both.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(physics.has_flag(F.col("anomaly_flags"), "ZT_CROSSCHECK_FAIL")).alias("n_mismatch"), F.round(F.avg(gap), 9).alias("bias"), F.round(F.sqrt(F.avg(gap * gap)), 9).alias("rmse"))


@query("SELECT source_file, kind FROM (SELECT source_file, CASE WHEN payload IS NULL OR trim(payload) = '' THEN 'EMPTY' WHEN NOT json_valid(payload) THEN 'UNREADABLE' END AS kind FROM raw_files) WHERE kind IS NOT NULL ORDER BY source_file LIMIT 10")
def first_errors(spark, sf_dir):
    """The first ten files that cannot be read, by name: a report for the log."""
    p = F.col("payload")
    kind = F.when(p.isNull() | (F.trim(p) == ""), "EMPTY").when(F.try_parse_json(p).isNull(), "UNREADABLE")
    return table(spark, sf_dir, "raw_files").select("source_file", kind.alias("kind")).filter("kind IS NOT NULL").orderBy("source_file", "kind").limit(10)


#: Names of the properties that the name filter keeps, and the role of each.
_TARGETS = {"Seebeck coefficient": "S", "Electrical conductivity": "Sigma", "Electrical resistivity": "Rho", "Thermal conductivity": "Kappa", "ZT": "ZT_reported"}


@query(
    f"""SELECT role, count(*) AS n_points FROM (SELECT CASE propertyname {" ".join(f"WHEN '{n}' THEN '{r}' END" if r == "ZT_reported" else f"WHEN '{n}' THEN '{r}'" for n, r in _TARGETS.items())} AS role FROM fact_measurements f
        JOIN (SELECT DISTINCT property_id, propertyname FROM dim_properties) y ON y.property_id = f.property_id_y WHERE f.property_id_x = 1) WHERE role IS NOT NULL GROUP BY 1"""
)
def property_name_filter(spark, sf_dir):
    """Points over temperature whose property is one of the named ones, by role."""
    names = table(spark, sf_dir, "dim_properties").select(F.col("property_id").alias("property_id_y"), "propertyname").distinct()
    kept = temperature_facts(spark, sf_dir).select("property_id_y").join(clean.named_properties(names, "propertyname", _TARGETS), "property_id_y")
    return kept.groupBy("role").agg(F.count(F.lit(1)).alias("n_points"))


@query(
    f"""SELECT count(*) AS n_states, round(1e2 * count(*) FILTER (audit_tier = 1) / count(*), 9) AS pct_tier_a, round(1e2 * count(*) FILTER (audit_tier = 4) / count(*), 9) AS pct_rejected, count(z) AS n_zt, round(avg(z), 9) AS mean_zt,
        round(quantile_cont(z, 0.5), 9) AS median_zt, round(max(z), 9) AS max_zt, round(stddev_pop(z), 9) AS sd_zt, round(quantile_cont(z, 0.95), 9) AS p95_zt FROM (SELECT audit_tier, CASE WHEN audit_tier IN (1, 2) AND isfinite(zt_computed) THEN zt_computed END AS z FROM ({_AUDITED}))"""
)
def audit_telemetry(spark, sf_dir):
    """The summary of an audit."""
    one = stats.audit_telemetry(audited(spark, sf_dir))
    return one.select(*(F.round(c, 9).alias(c) if c.startswith(("pct", "mean", "median", "max", "sd", "p95")) else c for c in one.columns))


@query(
    f"""SELECT count(*) AS n_states, count(DISTINCT paper_id) AS n_papers, count(DISTINCT CASE WHEN true THEN concat(paper_id, '/', sample_id) END) AS n_samples, round(avg(z), 9) AS mean_zt, round(stddev_samp(z), 9) AS sd_zt, round(min(z), 9) AS least_zt,
        round(quantile_cont(z, 0.5), 9) AS median_zt, round(max(z), 9) AS largest_zt FROM (SELECT paper_id, sample_id, CASE WHEN isfinite(zt_computed) THEN zt_computed END AS z FROM ({_AUDITED}) WHERE audit_tier BETWEEN 1 AND 3)"""
)
def certificate(spark, sf_dir):
    """What a release certifies of its usable states."""
    one = stats.certificate(audited(spark, sf_dir))
    return one.select(*(F.round(c, 9).alias(c) if c.endswith("_zt") else c for c in one.columns))


#: Documents of either root: a list of two documents, one document, a broken one, and points without or with an unknown property.
_LENIENT = """CASE o_orderkey % 5 WHEN 0 THEN concat('[{"rawdata":[{"propertyid_y":2,"x":1,"y":', CAST(o_custkey AS STRING), '}]},{"rawdata":[{"propertyid_y":4,"x":2,"y":3,"propertyid_x":7}]}]')
 WHEN 1 THEN concat('{"rawdata":[{"propertyid_y":3,"x":1,"y":', CAST(o_custkey AS STRING), '},{"x":5,"y":6},{"propertyid_y":99,"x":5,"y":6}]}') WHEN 2 THEN '{"rawdata":[{"propertyid_y":2' WHEN 3 THEN '{"sample":[]}' ELSE '{"rawdata":[{"propertyid_y":null,"x":1,"y":1}]}' END"""


@query(
    """SELECT o_orderkey AS id, entry, position, pid AS property_id_y, px AS property_id_x, x, coalesce(y, o_custkey) AS y, pid <> 99 AS allowed FROM orders JOIN (VALUES (0, 0, 0, 2, 1, 1e0, NULL), (0, 1, 0, 4, 7, 2e0, 3e0), (1, 0, 0, 3, 1, 1e0, NULL), (1, 0, 2, 99, 1, 5e0, 6e0)) v(k, entry, position, pid, px, x, y) ON o_orderkey % 5 = k"""
)
def lenient_points(spark, sf_dir):
    """Points of documents read leniently: lists of documents too, points without a property passed over, unknown properties marked."""
    points = corpus.lenient_points(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_LENIENT).alias("payload")))
    return points.select("id", "entry", "position", "property_id_y", "property_id_x", "x", "y", "allowed")


@query("SELECT row_id, CASE WHEN regexp_full_match(trim(sampleid), '[0-9]+') AND TRY_CAST(trim(sampleid) AS HUGEINT) <= 4294967295 THEN TRY_CAST(trim(sampleid) AS BIGINT) END AS id FROM interpolated_states")
def flexible_ids(spark, sf_dir):
    """Ids given as padded or zero-filled text, as whole numbers."""
    return table(spark, sf_dir, "interpolated_states").select("row_id", text.flexible_id(F.col("sampleid")).alias("id"))


@query("SELECT l_orderkey, l_linenumber, round(exp(l_discount), 12) AS value, round(exp(l_discount) * 1e-2, 12) AS uncertainty FROM lineitem")
def quantity_exponential(spark, sf_dir):
    """e to a dimensionless quantity, with its uncertainty."""
    e = units.exponential(units.quantity(F.col("l_discount"), F.lit(0.01), [0] * 7))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", e.alias("e")).select("l_orderkey", "l_linenumber", F.round("e.value", 12).alias("value"), F.round("e.uncertainty", 12).alias("uncertainty"))


@query(f"SELECT paper_id, n_points, gap_score FROM ({ORACLE['information_gain']}) ORDER BY gap_score DESC, paper_id LIMIT 20")
def gap_ranking(spark, sf_dir):
    """The twenty papers whose temperatures are worth most to fill."""
    return QUERIES["information_gain"](spark, sf_dir).orderBy(F.desc("gap_score"), "paper_id").limit(20).select("paper_id", "n_points", "gap_score")
