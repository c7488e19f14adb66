"""Whole pipelines on small inputs, and the plans of the main operators."""

import json

import pytest

from kelvinlake.operators import clean, rank, states
from kelvinlake.plans import data_queries, pipelines, reference_queries
from kelvinlake.session import table
from kelvinlake.sinks import writers


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return plan(df).split("== Physical Plan ==")[1]


def test_build_corpus(spark, tmp_path):
    def m(sample, x, prop, y):
        return {"paperid": 1, "sampleid": sample, "figureid": 3, "x": x, "y": y, "propertyid_x": 1, "propertyid_y": prop}

    rows = [m(1, 300.0, 2, 2e-4), m(1, 301.0, 3, 1e5), m(1, 302.0, 4, 1.5), m(2, 300.0, 2, 1e-4)]
    for domain in ("samples", "papers"):
        folder = tmp_path / domain / "s1"
        folder.mkdir(parents=True)
        (folder / "1.json").write_text(json.dumps({"sample": [{"sampleid": 1, "paperid": 1, "composition": domain}], "paper": [{"paperid": 1, "title": domain}], "figure": [{"figureid": 3, "paperid": 1}], "rawdata": rows}))
    t = pipelines.build_corpus(spark, {d: f"file://{tmp_path}/{d}" for d in ("papers", "samples")}, str(tmp_path / "out"))
    assert t["fact_measurements"].count() == 4 and {r[0] for r in t["fact_measurements"].select("source_domain").distinct().collect()} == {"samples"}
    assert t["dim_papers"].first()["title"] == "samples" and t["dim_samples"].count() == 1
    out = {r["sample_id"]: (r["audit_tier"], r["anomaly_flags"]) for r in spark.read.parquet(f"{tmp_path}/out/thermoelectric_states.parquet").collect()}
    assert out == {1: (1, 0), 2: (4, 0)}


def test_publication_dataset(spark):
    df = spark.createDataFrame([(1, "2e-4", 1e5, 1.5, 300.0, "PbTe", 7, 1e-5), (2, "2e-4", 1e5, 1.5, 310.0, "PbTe", 7, 2e-5), (3, "x", 1e5, 1.5, 300.0, None, None, None)], "n int, S string, sigma double, kappa double, T double, composition string, doi int, rho double")
    out = pipelines.publication_dataset(df, "n").orderBy("anomaly_flags").collect()
    assert [(r["confidence_tier"], r["anomaly_flags"]) for r in out] == [(1, 0), (1, 1024 + 8), (4, 2048)]
    assert pipelines.publication_dataset(df, "n", skip_dedup=True).filter("anomaly_flags = 8").count() == 1


def test_publication_query_has_all_fields_and_duplicate_bits(spark, sf_dir):
    df = reference_queries.QUERIES["publication_dataset_full"](spark, sf_dir)
    assert df.columns == [n for n, _ in writers.PUBLICATION]
    expected = {r["row_id"] for r in reference_queries.QUERIES["dedup_flags_row"](spark, sf_dir).filter("dup_flag = 1024").collect()}
    assert expected and {r["sample_id"] for r in df.filter("anomaly_flags & 1024 <> 0").collect()} == expected


def test_records(spark):
    curves = spark.createDataFrame([(1, "[300, 310]", "[2e-4, 2e-4]", "[1e5, 1e5]", "[1.5, 1.5]"), (2, "[300]", "[2e-4, 1]", "[1e5]", "[1.5]"), (3, "[300]", "[2e-4]", "[1e5]", "[-1]"), (4, "oops", "[1]", "[1]", "[1]")], "sample_id int, temperature string, seebeck string, electrical_conductivity string, thermal_conductivity string")
    samples = spark.createDataFrame([(i, "d") for i in range(1, 5)], "sample_id int, doi string")
    papers = spark.createDataFrame([("d", None)], "doi string, credibility_prior double")
    r = pipelines.run_records(curves, samples, papers)
    assert (r.processed, r.inserted, r.failed, r.violations) == (4, 1, 3, 1) and abs(r.mean_zt - 0.8133333333) < 1e-6
    with pytest.raises(Exception, match="KAPPA_NOT_POSITIVE"):
        pipelines.run_records(curves, samples, papers, strict=True)
    with pytest.raises(ValueError, match="inconsistent"):
        pipelines.PipelineResult(1, 1, 1, 0, 0.0, 0.0)


def test_before_and_after(spark, sf_dir):
    out = pipelines.before_and_after(table(spark, sf_dir, "fact_measurements"))
    assert all(df.count() > 0 for df in out.values())
    assert out["two_sample"].filter("distance BETWEEN 0 AND 1").count() >= 1


def test_pivot_plan_has_one_shuffle_and_no_python(spark, sf_dir):
    p = physical(states.state_table(reference_queries.temperature_facts(spark, sf_dir)))
    assert p.count("Exchange") == 1 and "Python" not in p and "Arrow" not in p
    assert "PushedFilters: [" in p and "property_id_x" in p.split("PushedFilters")[1]
    assert "source_file" not in p.split("ReadSchema")[1]


def test_row_functions_do_not_shuffle(spark, sf_dir):
    for name in ("physics_audit", "zt_batch", "wf_decomposition", "error_propagation", "state_codes", "quality_score", "credibility_score"):
        p = physical(reference_queries.QUERIES[name](spark, sf_dir))
        assert "Exchange" not in p and "Python" not in p, name


def test_dedup_and_ranking_combine_before_the_shuffle(spark, sf_dir):
    f = table(spark, sf_dir, "fact_measurements")
    p = physical(clean.cross_domain_dedup(f))
    assert p.count("Exchange") == 1 and "partial_min_by" in p
    p = physical(rank.information_gain(f, "paper_id", "x_si"))
    assert "partial_count" in p and "Window" not in p


def test_links_come_from_joins_of_entities(spark, sf_dir):
    """Places are found by a join with the owner; the nodes of an object are one row before the shuffle."""
    assert "Join" in physical(data_queries.p1_found(spark, sf_dir))
    assert "partial_max" in physical(data_queries.p1_records(spark, sf_dir))


def test_orphans_are_probed_by_bloom_filter(spark, sf_dir):
    p = physical(data_queries.p5_found(spark, sf_dir))
    assert "might_contain" in p and "bloom_filter_agg" in p and "CartesianProduct" not in p


def test_queries_take_whole_tables(spark, sf_dir):
    """A limit is only in reports of the top rows and in the sampling operator."""
    allowed = {"material_rank_top10", "family_counts", "element_systems", "worst_conflicts", "reservoir_sample", "first_errors", "gap_ranking"}
    for name, f in reference_queries.QUERIES.items():
        if name not in allowed and not name.startswith(("scan_", "stream_", "canonical", "zt_crosscheck_pchip")):
            assert "Limit" not in plan(f(spark, sf_dir)).split("== Optimized")[0], name
