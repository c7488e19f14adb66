"""Nested records, small files and schema drift against brute force; wide tables and orphans on edge cases."""

import json
from collections import Counter
from datetime import datetime

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kelvinlake.operators import bloom, compact, drift, json_tree, orphans, wide
from kelvinlake.operators.ordered import with_previous
from kelvinlake.plans import data_queries as q
from kelvinlake.session import written


def read(sf_dir, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def document(text):
    try:
        v = json.loads(text) if text else None
        v = json.loads(v) if isinstance(v, str) else v
    except ValueError:
        return None
    return v if isinstance(v, dict) else None


def items(v):
    return v if isinstance(v, list) else [v] if isinstance(v, dict) else []


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def brute_objects(origin, key, doc, outer, inner):
    at = doc
    for part in outer.split("."):
        at = at.get(part) if isinstance(at, dict) else None
    for i, o in enumerate(items(at)):
        if isinstance(o, dict):
            yield origin, key, outer, i, -1
            for name in inner:
                for j, x in enumerate(items(o.get(name))):
                    if isinstance(x, dict):
                        yield origin, key, f"{outer}.{name}", i, j


def test_p1_found(spark, sf_dir):
    expected = Counter()
    for key, text in read(sf_dir, "dim_samples", "row_id, sampleinfo_json"):
        for outer, inner in (("FabricationProcess.steps", ["conditions"]), ("ThermalMeasurement.instruments", ["calibrations"]), ("ElectricalMeasurement.instruments", ["calibrations"]), ("GrainSize.readings", [])):
            expected.update(brute_objects("dim_samples", key, document(text) or {}, outer, inner))
    for key, text in read(sf_dir, "raw_files", "file_id, payload"):
        expected.update(brute_objects("raw_files", key, document(text) or {}, "rawdata", []))
        expected.update(brute_objects("raw_files", key, document(text) or {}, "data_points", ["repeats"]))
    assert rows(q.p1_found(spark, sf_dir).select("origin", "parent_id", "branch", "outer_pos", "inner_pos")) == expected


def test_p1_entities_hold_scalars(spark, sf_dir):
    expected = Counter()
    for key, text in read(sf_dir, "raw_files", "file_id, payload"):
        for i, o in enumerate(items((document(text) or {}).get("rawdata"))):
            if isinstance(o, dict):
                expected[(key, i, None if o.get("x") is None else float(o["x"]))] += 1
    assert rows(q.p1_records(spark, sf_dir).select("file_id", "rec_pos", "x")) == expected
    steps = q.p1_steps(spark, sf_dir)
    assert steps.count() == q.p1_found(spark, sf_dir).filter("branch = 'FabricationProcess.steps.conditions'").count()


def test_shred_edge_cases(spark):
    texts = [None, "", " ", "[]", "3", '{"a":1} x', '{"a":', '"{\\"a\\":[{\\"b\\":[1,{\\"c\\":\\"é\\"}]},null,{\\"b\\":{\\"c\\":2}}]}"', json.dumps({"t": "x" * 200_000})]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)] + [(None, "{}", "own")], "id long, j string, path string")
    nodes = json_tree.shred(df, "id", "j", ["a", "a[].b"])
    assert {r["doc_id"] for r in nodes.select("doc_id").collect()} == {7, 8}
    both = written(json_tree.entities(nodes, {"a[]": [], "a[].b[]": ["c"]}), "entities")
    placed = json_tree.with_places(both).collect()
    assert sorted((r["branch"], r["outer_pos"], r["inner_pos"], r["v_c"]) for r in placed) == [("a[]", 0, -1, None), ("a[]", 2, -1, None), ("a[].b[]", 0, 1, "é"), ("a[].b[]", 2, 0, "2")]
    assert nodes.filter("path = 't'").first()["scalar"] == "x" * 200_000
    assert json_tree.shred(df.limit(0), "id", "j").count() == 0


def test_p3_edge_cases(spark):
    a = (wide.Attribute("s", ((2, "v"),)), wide.Attribute("c", ((3, "v"), (5, "CASE WHEN v > 0 THEN 1/v END"))), wide.Attribute("k", ((4, "v"),)))
    data = [(1, 2, 4.0), (1, 2, 6.0), (1, 5, 0.5), (1, 5, -1.0), (None, 2, 1.0), (2, 9, 1.0), (2, 4, float("nan")), (2, 4, None), (3, 4, float("inf")), (4, 4, 7.0)]
    df = spark.createDataFrame(data, "e int, p int, y double")
    out = {r["e"]: (r["s"], r["n_s"], r["c"], r["k"], r["n_k"]) for r in wide.widen(df, ["e"], "p", "y", a).collect()}
    assert out == {1: (5.0, 2, 2.0, None, 0), None: (1.0, 1, None, None, 0), 4: (None, 0, None, 7.0, 1)}
    assert wide.widen(df.limit(0), ["e"], "p", "y", a).count() == 0


def test_p3_joins_shuffle_nothing(spark, sf_dir):
    """The narrow tables are co-partitioned by entity: the joins of the plan need no exchange by hash."""
    plan = q.p3_wide(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange hashpartitioning" not in plan


def test_p4_found(spark, sf_dir):
    seen, expected = set(), Counter()
    for key, text in sorted(read(sf_dir, "raw_files", "file_id, payload")):
        for i, o in enumerate(items((document(text) or {}).get("rawdata"))):
            record = tuple(compact.as_number(o.get(f)) for f in compact.RECORD_FIELDS) if isinstance(o, dict) else (None,)
            if None in record:
                continue
            if record in seen:
                expected[(key, i)] += 1
            seen.add(record)
    assert expected
    assert rows(q.p4_found(spark, sf_dir).select("file_id", "rec_pos")) == expected


def test_compaction_keeps_every_row(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    df = spark.createDataFrame([(i, 7 if i % 3 else i, None if i % 5 == 0 else "x" * 50, [i]) for i in range(2000)] + [(0, 0, None, [0])] * 3, "id long, k int, t string, a array<long>")
    done = compact.compact(df, out, ["k"], ["id"], target_bytes=20_000)
    back = spark.read.parquet(out)
    assert done.rows == 2003 == back.count() and done.files > 3
    assert back.exceptAll(df).count() == 0
    again = compact.compact(df.limit(5), out, ["k"], ["id"])
    assert (again.rows, again.files, spark.read.parquet(out).count()) == (5, 1, 5)
    assert compact.compact(df.limit(0), out, ["k"], ["id"]).rows == 0
    assert spark.read.parquet(out).count() == 0


def test_compaction_cuts_even_files(spark, tmp_path):
    """Boundaries are sampled: many files of about the target, even with a key that holds a third of all rows; ranges do not overlap."""
    out = f"file://{tmp_path}/even"
    df = spark.range(40_000).selectExpr("id", "IF(id % 3 = 0, 7L, id % 1000) AS k", "repeat('x', 40) AS t")
    done = compact.compact(df, out, ["k"], ["id"], target_bytes=100_000)
    per = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "id")).alias("a"), F.max(F.struct("k", "id")).alias("b")).orderBy("a").collect()
    assert done.files == len(per) > 15 and max(r["n"] for r in per) < 3 * 40_000 / len(per)
    assert all(x["b"] < y["a"] for x, y in zip(per, per[1:], strict=False))


@pytest.mark.parametrize(("value", "number"), [(1, 1.0), ("1e2", 100.0), (" 2.50 ", 2.5), (True, None), (None, None), ("1_0", None), ("nan", None), ("x", None), ("", None), ([1], None), (-0.0, 0.0)])
def test_as_number(value, number):
    assert compact.as_number(value) == number


def test_p5_without_the_filter(spark, sf_dir, monkeypatch):
    """Where Spark gives no access to its Bloom filter, exact joins find the same orphans."""
    expected = rows(q.p5_found(spark, sf_dir))
    monkeypatch.setattr(bloom, "InternalFunction", None)
    assert expected and rows(q.p5_found(spark, sf_dir)) == expected


def test_p5_edge_cases(spark):
    t = lambda d: datetime(2024, 1, d)
    child = spark.createDataFrame(
        [(1, 10, 1, t(5)), (2, 10, 1, t(1)), (3, 11, 1, t(5)), (4, None, 1, t(5)), (5, 0, 1, t(5)), (6, 10, None, t(5)), (7, 10, 1, None), (8, 12, 1, t(3)), (9, 12, 1, t(4)), (9, 11, 1, t(5))],
        "id long, s int, p int, ingested_at timestamp",
    )
    parent = spark.createDataFrame([(10, 1, t(2), None), (10, 1, t(2), None), (11, 2, t(1), None), (12, 1, t(1), t(2)), (12, 1, t(3), t(4)), (None, 1, t(1), None)], "s int, p int, ingested_at timestamp, deleted_at timestamp")
    ref = [orphans.Reference("c", "id", "s", ("s", "p"), "p", ("s", "p"))]
    found = orphans.find_orphans({"c": child}, {"p": parent}, ref)
    assert sorted(r["child_id"] for r in found.collect()) == [2, 3, 5, 6, 7, 9, 9]
    assert orphans.find_orphans({"c": child}, {"p": parent.limit(0)}, ref).count() == 9
    assert orphans.find_orphans({"c": child.limit(0)}, {"p": parent}, ref).count() == 0
    assert {r["month"] for r in orphans.orphan_report(found).collect()} == {"2024-01", None}


def brute_changes(sf_dir):
    feeds = {}
    for key, feed, at, text in read(sf_dir, "raw_files", "file_id, feed, exported_at, payload"):
        doc = document(text)
        records = [o for a in ("rawdata", "data_points") for o in items((doc or {}).get(a)) if isinstance(o, dict)]
        if not records:
            continue
        fields = {}
        for part, objects in (("root", [doc]), ("record", records)):
            for o in objects:
                for k, v in o.items():
                    if v is not None:
                        fields.setdefault(f"{part}.{k}", set()).add(json_tree.kind_of(v))
        feeds.setdefault(feed, []).append((at, key, fields))
    for files in feeds.values():
        files.sort(key=lambda f: f[:2])
        for (_, _, a), (_, key, b) in zip(files, files[1:]):
            yield from ((key, f, "removed") for f in a.keys() - b.keys())
            yield from ((key, f, "added") for f in b.keys() - a.keys())
            yield from ((key, f, "retyped") for f in a.keys() & b.keys() if a[f] != b[f])


def test_p6_found(spark, sf_dir):
    assert rows(q.p6_found(spark, sf_dir).select("file_id", "field_path", "change_kind")) == Counter(brute_changes(sf_dir))


names = st.sampled_from(["a", "b", "ab", "sampleid", "sample_id", "sampleId", "x.y"])
schema = st.dictionaries(names, st.sampled_from([1, "s", [1], {"a": 1}, {"b": {"a": 2}}, None]), max_size=6)


@settings(max_examples=150, deadline=None)
@given(schema, schema, schema, schema)
def test_scripts_turn_one_schema_into_the_other(root1, rec1, root2, rec2):
    trees = [drift.schema_tree({**r, "rawdata": [o]}) for r, o in ((root1, rec1), (root2, rec2))]

    def paths(tree):
        return {n[3]: n[1] for n in drift._postorder(tree)[0]}

    fields = paths(trees[0])
    for op, old, new, _, kinds, _, _ in sorted(drift.edit_script(*trees), key=lambda s: s[0] in ("add", "rename", "move")):
        if op != "add":
            fields.pop(old, None) if op != "retype" else None
        if new is not None and op == "retype":
            fields[new] = kinds
    for op, _, new, _, kinds, _, _ in drift.edit_script(*trees):
        if op in ("add", "rename", "move"):
            fields[new] = kinds
    assert fields == paths(trees[1])


def test_with_previous_over_partitions(spark):
    data = [("hot" if i % 3 else None if i % 2 else f"g{i % 7}", i, i * i) for i in range(500)]
    out = with_previous(spark.createDataFrame(data, "g string, o long, v long"), "g", ["o"], ["v"], partitions=16)
    last, expected = {}, {}
    for g, o, v in data:
        expected[o], last[g] = last.get(g), v
    assert {r["o"]: r["prev_v"] for r in out.collect()} == expected


def test_unified_records(spark):
    payloads = ['{"rawdata":[{"sampleid":1,"x":2,"q":[1]},5,{"sample_id":"7"}]}', '{"sampleid":9,"data_points":{"x":"3"}}', None, "{", "{}"]
    df = spark.createDataFrame(list(enumerate(payloads)), "file_id long, payload string")
    out = drift.unified_records(df, {"sampleid": ["sampleid", "sample_id"]}, ("sampleid", "x")).collect()
    assert sorted((r["file_id"], r["array_name"], r["rec_pos"], r["sampleid"], r["x"] or "", r["extra"]) for r in out) == [(0, "rawdata", 0, "1", "2", '{"q": [1]}'), (0, "rawdata", 2, "7", "", None), (1, "data_points", 0, "9", "3", None)]


def test_renames_are_merged_on_evidence(spark):
    def record(fig, **kw):
        return json.dumps({"rawdata": [{"x": 1, "y": 2, fig: 5} | kw], "lab": "k"})

    payloads = [record("figureid", err_x=1), record("figId", err_x=1), record("figureid"), record("figureid", err_y=1), json.dumps({"rawdata": [{"figureid": 5, "err_x": 1, "err_y": 2}]})]
    raw = spark.createDataFrame([(i, "f", datetime(2024, 1, 1 + i), p) for i, p in enumerate(payloads)], "file_id long, feed string, exported_at timestamp, payload string")
    projection = drift.compile_projection(drift.change_scripts(raw), raw)
    assert [sorted(m) for m in projection.names.values()] == [["figId", "figureid"]]
    for keyed in (projection, {"figId": ["figId", "figureid"]}):
        out = {r["file_id"]: r for r in drift.unified_records(raw, keyed, ("figureid", "x")).collect()}
        assert {r["figureid"] for r in out.values()} == {"5"}
        assert json.loads(out[1]["extra"]) == {"y": 2, "err_x": 1, "root.lab": "k"}


def test_whole_scripts_are_compiled(spark):
    """Moves, retypings, additions and deletions: one projection per schema, and no value lost."""
    payloads = [
        {"sample_id": 4, "rawdata": [{"x": 1, "y": 2}]}, {"rawdata": [{"sample_id": 4, "x": "1.0", "y": 2}]}, {"sample_id": 4, "rawdata": [{"x": 1, "y": 2}]}, {"rawdata": [{"sample_id": 4, "x": 1, "meta": {"fig": 9}}]},
        {"rawdata": [{"sample_id": 4, "x": 1, "fig": 9, "err": 3}]},
    ]
    raw = spark.createDataFrame([(i, "f", datetime(2024, 1, 1 + i), json.dumps(p)) for i, p in enumerate(payloads)], "file_id long, feed string, exported_at timestamp, payload string")
    plan = drift.compile_projection(drift.change_scripts(raw), raw)
    assert plan.moved == {"sample_id": ["root.sample_id"], "fig": ["record.meta.fig"]} and plan.numbers == {"x"}
    out = {r["file_id"]: r for r in drift.unified_records(raw, plan, ("sample_id", "x", "y", "fig")).collect()}
    assert [out[i]["sample_id"] for i in range(5)] == ["4"] * 5 and [out[i]["x"] for i in range(5)] == ["1"] * 5
    assert [out[i]["y"] for i in range(5)] == ["2", "2", "2", None, None] and [out[i]["fig"] for i in range(5)] == [None, None, None, "9", "9"]
    assert json.loads(out[4]["extra"]) == {"err": 3}


@pytest.mark.parametrize("depth", [12, 200])
def test_scripts_reach_every_depth(depth):
    def tree(leaf):
        inner = {leaf: 1}
        for i in range(depth):
            inner = {f"k{i}": inner}
        return drift.schema_tree({"rawdata": [inner]})

    (step,) = drift.edit_script(tree("qqq"), tree("qqqz"))
    assert step[0] == "rename" and step[1].endswith(".k0.qqq") and step[1].count(".") == depth + 1
