"""Sources, sinks and streaming on small files."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvinlake.functions import physics
from kelvinlake.plans import reference_queries
from kelvinlake.session import table
from kelvinlake.sinks import writers
from kelvinlake.sources import corpus, tabular
from kelvinlake.streaming import ingest


def measurement(**kw):
    return {"paperid": 1, "sampleid": "2", "figureid": 3, "x": 300.0, "y": 1e-4, "propertyid_x": 1, "propertyid_y": 2} | kw


@pytest.fixture
def root(tmp_path):
    base = tmp_path / "samples"
    good = {
        "sample": [{"sampleid": " 2 ", "paperid": 1, "samplename": "n", "composition": "PbTe", "sampleinfo": {"Form": {"category": " bulk ", "comment": ""}}}],
        "paper": [{"paperid": 1, "doi": "d", "title": 5, "year": 2001}],
        "figure": [{"figureid": "3", "paperid": 1}],
        "rawdata": [measurement(), measurement(propertyid_y=20), measurement(figureid=9), measurement(x="310.5")],
        "unknown": [1],
    }
    for name, body in (("a/1.json", json.dumps(good)), ("a/2.json", "{broken"), ("b/3.json", json.dumps({"rawdata": [measurement(sampleid=None)]})), ("b/4.txt", "x"), ("5.json", "{}")):
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    return f"file://{base}"


def test_scan_domain(spark, root, tmp_path):
    files = corpus.scan_domain(spark, root, "samples")
    errors = {r["source_file"].rsplit("/", 1)[1]: r["error"] for r in files.collect()}
    assert errors == {"1.json": None, "2.json": "UNREADABLE", "3.json": "FIELD_MISSING"}
    s = corpus.scan_summary(files).first()
    assert (s["files_seen"], s["files_failed"], s["n_kept"], s["n_rejected"], s["n_figure_mismatch"]) == (3, 2, 3, 1, 1)
    m = corpus.measurements(files).orderBy("position").collect()
    assert [(r["x"], r["anomaly_flags"]) for r in m] == [(300.0, 0), (300.0, 512), (310.5, 0)]
    assert corpus.samples(files).first()["form"] == "bulk" and corpus.papers(files).first()["title"] == "5"
    assert corpus.figures(files).first()["figure_id"] == 3 and corpus.properties(files).count() == 0
    assert {r["property_id_y"]: r["n_points"] for r in corpus.count_by_property(spark, root).collect()} == {2: 3, 20: 1}
    assert corpus.list_files(spark, root).count() == 4
    with pytest.raises(FileNotFoundError):
        corpus.shard_paths(spark, f"file://{tmp_path}/none")


def test_scan_keeps_every_file_once(spark, tmp_path):
    texts = [None, "", "  \n", "null", "[]", "[{}, {}]", "{broken", json.dumps({"rawdata": [measurement(), measurement(y=None)]}), json.dumps({"rawdata": [measurement()]}), "\ufeff{}"]
    root = f"{tmp_path}/corpus"
    rows = spark.createDataFrame(list(enumerate(texts)), "file_id long, payload string")
    assert writers.write_json_files(rows, root, 3) == len(texts)
    for files in (corpus.scan_domain(spark, f"file://{root}", "samples"), corpus.scan_domain(spark, f"file:{root}", "samples", recursive=True)):
        errors = {int(r["source_file"].rsplit("/", 1)[1].split(".")[0]): r["error"] for r in files.collect()}
        assert files.count() == len(texts) and errors == {i: "UNREADABLE" for i in range(7)} | {7: "FIELD_MISSING", 8: None, 9: None}
        assert corpus.measurements(files).count() == 1


def test_scan_query_refuses_files_with_missing_fields(spark, sf_dir):
    one = reference_queries.QUERIES["scan_json_corpus"](spark, sf_dir).first()
    assert one["files_seen"] == table(spark, sf_dir, "raw_files").count()
    assert one["files_field_missing"] > 0 and one["files_failed"] == one["files_unreadable"] + one["files_field_missing"]
    assert one["n_points"] == one["n_kept"] and one["n_points_mismatch"] == one["n_figure_mismatch"]


def test_two_shapes(spark):
    df = spark.createDataFrame([(1, '{"sample_id": 7, "data_points": [{"x": "1.5", "y": 2}, {"sampleid": 8, "x": "bad", "y": 1}]}'), (2, '{"rawdata": [{"sample_id": "9", "x": 1, "y": 2}]}'), (3, "{}"), (4, None)], "id int, payload string")
    assert sorted((r["id"], r["sample_id"], r["x"]) for r in corpus.two_shape_points(df).collect()) == [(1, 7, 1.5), (2, 9, 1.0)]


def test_tables(spark, tmp_path):
    (tmp_path / "t.csv").write_text("composition,sampleid,Temperature,Seebeck (V/K),Resistivity,Thermal conductivity\nPbTe,,300.5,\"[1, 2e-4]\",0.01,1.5\nPbTe,,301.2,x,0.02,\nPbTe,s,bad,1,1,1\n")
    df = tabular.load(spark, f"{tmp_path}/t.csv").withColumn("row_no", F.monotonically_increasing_id())
    out = {r["t"]: r for r in tabular.csv_states(df, "row_no").collect()}
    assert out[301]["s"] == 2e-4 and out[301]["sigma"] == 50.0 and out[301]["kappa"] == 1.5 and set(out) == {301}
    assert tabular.csv_roles(["electrical_conductivity", "Electrical Conductivity", "ρ", "ρ of x"]) == {"t": [], "s": [], "sigma": ["Electrical Conductivity"], "rho": ["ρ"], "kappa": []}
    both = spark.createDataFrame([(1.0, 2.0, 3.0)], "S double, seebeck double, sigma_S_m double")
    assert (tabular.resolve(both, "s"), tabular.resolve(both, "sigma"), tabular.resolve(both, "kappa")) == ("seebeck", "sigma_S_m", None)
    with pytest.raises(ValueError, match="kind"):
        tabular.load(spark, "x.xls")
    wide = spark.createDataFrame([("1e-4", 1.0, 2.0, 300, "z")], "S string, sigma double, kappa double, temperature int, note string")
    assert tabular.numeric_states(wide).first().asDict() == {"s": 1e-4, "sigma": 1.0, "kappa": 2.0, "t": 300.0, "zt": None, "note": "z"}
    with pytest.raises(ValueError, match="kappa"):
        tabular.numeric_states(wide.drop("kappa"))
    (tmp_path / "c.yaml").write_text("a: 1\ndb:\n  host: h # c\n  port: 5\n")
    assert tabular.read_config(f"{tmp_path}/c.yaml") == {"a": 1, "db": {"host": "h", "port": 5}}
    assert tabular.synthetic_states(spark, 100).filter("kappa - 2.44e-8 * sigma * t >= 0.4").count() == 100


def test_sinks(spark, tmp_path, monkeypatch):
    states = physics.audit(spark.createDataFrame([(1, 2e-4, 1e5, 1.5, 300.0, None), (2, None, 1e5, 1.5, 300.0, None), (3, 2e-4, 1e5, 0.3, 50.0, None)], "id int, s double, sigma double, kappa double, t double, zt_reported double"), incomplete_flags=0)
    bad = {r["id"]: (r["rejection_stage"], r["reasons"]) for r in writers.bad_records(states).collect()}
    assert bad == {2: ("incomplete", ""), 3: ("temperature", "TEMPERATURE_OUT_OF_RANGE")}
    writers.write_jsonl(writers.bad_records(states), f"{tmp_path}/bad")
    assert spark.read.json(f"{tmp_path}/bad").count() == 2
    p = writers.publication_rows(states.withColumn("sample_id", F.col("id")))
    assert [(f.name, f.dataType.simpleString().replace("bigint", "long")) for f in p.schema] == list(writers.PUBLICATION)
    assert p.first()["composition"] == "unknown" and p.first()["paper_id"] == 0
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.DoubleType())])
    assert writers.write_checked(states.select("s", "id"), f"{tmp_path}/checked", schema) == 3
    assert tabular.read_parquet_checked(spark, f"{tmp_path}/checked", schema).count() == 3
    real, moves = writers.swap_folders.__globals__["filesystem"], []

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            moves.append(str(a))
            return False if str(a).endswith(".staging") else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    monkeypatch.setitem(writers.swap_folders.__globals__, "filesystem", lambda s, p: (Broken(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="moved"):
        writers.write_checked(states.select("s", "id").limit(1), f"{tmp_path}/checked", schema)
    monkeypatch.undo()
    assert len(moves) == 3 and tabular.read_parquet_checked(spark, f"{tmp_path}/checked", schema).count() == 3
    with pytest.raises(ValueError, match="columns"):
        writers.write_checked(states, f"{tmp_path}/checked", schema)
    with pytest.raises(ValueError, match="schema"):
        tabular.read_parquet_checked(spark, f"{tmp_path}/checked", T.StructType([T.StructField("id", T.StringType())]))
    assert writers.write_json_summary(states.agg(F.count("id").alias("n")), f"{tmp_path}/s.json") == {"n": 3} == tabular.read_json_metadata(f"{tmp_path}/s.json")
    assert "| 3 |" in writers.write_report(f"{tmp_path}/r.md", "Report", {"Counts": states.agg(F.count("id").alias("n"))})
    with pytest.raises(ValueError, match="more than"):
        writers.markdown_table(spark.range(9), "t", most=3)
    paths = writers.export_tables({"states": states}, str(tmp_path))
    assert spark.read.parquet(paths["states"]).count() == 3


def test_manifest_and_nodes(spark, tmp_path):
    files = spark.createDataFrame([("a",), ("b",), ("b",)], "source_file string")
    path = f"{tmp_path}/manifest"
    assert writers.unprocessed(spark, files, path).count() == 3
    writers.append_manifest(files.filter("source_file = 'b'"), path, "r1")
    assert [r[0] for r in writers.unprocessed(spark, files, path).collect()] == ["a"]
    assert writers.material_nodes(files, "source_file").count() == 2
    assert {(r[0], r[1]) for r in writers.drift_between(files, files.filter("source_file = 'a'").union(spark.createDataFrame([("c",)], files.schema)), "source_file").collect()} == {("b", "sink"), ("c", "source")}


def test_stream_resumes(spark, tmp_path):
    columns = "measurement_id long, k int, property_id_y int, x_si double, y_si double, digitised_at timestamp"
    rows = lambda ids: spark.range(*ids).selectExpr("id AS measurement_id", "CAST(id % 4 AS int) AS k", "2 AS property_id_y", "300D AS x_si", "CASE WHEN id = 1 THEN double('nan') ELSE 1D END AS y_si", "timestamp '2024-01-01' + make_interval(0, 0, 0, CAST(id AS int)) AS digitised_at")
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"
    rows((0, 8)).write.parquet(source)

    def run():
        stream = ingest.clean_points(ingest.stream_files(spark, source, columns, files_per_batch=1)).dropDuplicates(["k"])
        ingest.run_available(stream, state, lambda df, _: df.write.mode("append").parquet(out))

    run()
    rows((8, 16)).write.mode("append").parquet(source)
    run()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]
    counts = ingest.windowed_counts(ingest.stream_files(spark, source, columns), "digitised_at", "4 days", "1 day")
    assert counts.isStreaming and set(counts.columns) == {"start", "property_id_y", "n", "mean"}
    assert ingest.dedup_stream(ingest.stream_files(spark, source, columns), ["k"], "digitised_at").isStreaming
