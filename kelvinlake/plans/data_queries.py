"""The pN_ queries of the core: nested records, wide tables, small files, orphans, schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvinlake.operators import compact, drift, json_tree, orphans, wide
from kelvinlake.session import scratch_path, table, written

# ---- p1: deeply nested records -------------------------------------------------------------------------------------

SAMPLE_BRANCHES = {
    "FabricationProcess.steps": ("name", "atmosphere"),
    "FabricationProcess.steps.conditions": ("param", "value", "unit"),
    "ThermalMeasurement.instruments": ("model",),
    "ThermalMeasurement.instruments.calibrations": ("standard", "offset_pct"),
    "ElectricalMeasurement.instruments": ("model",),
    "ElectricalMeasurement.instruments.calibrations": ("standard", "offset_pct"),
    "GrainSize.readings": ("um",),
}
FILE_BRANCHES = {
    "rawdata": ("paperid", "sampleid", "figureid", "propertyid_x", "propertyid_y", "x", "y"),
    "data_points": ("sampleid", "x", "y"),
    "data_points.repeats": ("x", "y"),
}


def _element_path(branch: str, branches: dict) -> str:
    """The node path of a branch's elements: each part that is itself a branch is an array."""
    parts, path, plain = branch.split("."), "", ""
    for p in parts:
        path, plain = (f"{path}.{p}" if path else p), (f"{plain}.{p}" if plain else p)
        if plain in branches:
            path += "[]"
    return path


def _entities(df: DataFrame, id_col: str, json_col: str, branches: dict[str, tuple[str, ...]]) -> DataFrame:
    """Shred the documents and put the objects of the branches together from the adjacency table."""
    paths = {_element_path(b, branches): names for b, names in branches.items()}
    nodes = json_tree.shred(df, id_col, json_col, [p.removesuffix("[]") for p in paths], list(paths))
    return json_tree.entities(nodes, paths)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object held in an array of the nested records, with its parent row and its place."""
    out = None
    for origin, id_col, json_col, branches in (
        ("dim_samples", "row_id", "sampleinfo_json", SAMPLE_BRANCHES),
        ("raw_files", "file_id", "payload", FILE_BRANCHES),
    ):
        entity = written(_entities(table(spark, sf_dir, origin), id_col, json_col, branches).select("doc_id", "entity_id", "branch", "owner_id", "pos"), "entities")
        named = F.create_map(*(F.lit(x) for b in branches for x in (_element_path(b, branches), b)))
        part = json_tree.with_places(entity).select(F.lit(origin).alias("origin"), F.col("doc_id").alias("parent_id"), named[F.col("branch")].alias("branch"), "outer_pos", "inner_pos")
        out = part if out is None else out.unionByName(part)
    return out


def p1_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity table of process conditions with their step, keeping both links."""
    branches = {b: SAMPLE_BRANCHES[b] for b in ("FabricationProcess.steps", "FabricationProcess.steps.conditions")}
    entity = written(_entities(table(spark, sf_dir, "dim_samples"), "row_id", "sampleinfo_json", branches), "entities")
    outer, inner = (_element_path(b, branches) for b in branches)
    step = entity.filter(F.col("branch") == outer).select("doc_id", F.col("entity_id").alias("owner_id"), F.col("pos").alias("step_pos"), F.col("v_name").alias("step_name"), F.col("v_atmosphere").alias("atmosphere"))
    return entity.filter(F.col("branch") == inner).join(step, ["doc_id", "owner_id"]).select(
        F.col("doc_id").alias("row_id"), "step_pos", F.col("pos").alias("condition_pos"), "step_name", "atmosphere",
        F.col("v_param").alias("param"), F.expr("try_cast(v_value AS double)").alias("value"), F.col("v_unit").alias("unit"),
    )


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity table of raw measurement records, one row per object in rawdata."""
    e = _entities(table(spark, sf_dir, "raw_files"), "file_id", "payload", {"rawdata": FILE_BRANCHES["rawdata"]})
    return e.select(F.col("doc_id").alias("file_id"), F.col("pos").alias("rec_pos"), *(F.expr(f"try_cast(v_{c} AS double)").alias(c) for c in FILE_BRANCHES["rawdata"]))


# ---- p3: attribute-value rows into a wide table ---------------------------------------------------------------------

STATE_ATTRIBUTES = (
    wide.Attribute("seebeck", ((2, "v"),)),
    wide.Attribute("conductivity", ((3, "CASE WHEN v > 0 THEN v END"), (5, "CASE WHEN v > 0 THEN 1 / v END"))),
    wide.Attribute("thermal_conductivity", ((4, "v"), (14, "v"))),
    wide.Attribute("resistivity", ((5, "CASE WHEN v > 0 THEN v END"),)),
    wide.Attribute("figure_of_merit", ((16, "v"),)),
)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per paper, sample and 10 K bin with a typed column per property."""
    rows = table(spark, sf_dir, "fact_measurements").select("paper_id", "sample_id", "property_id_x", "property_id_y", "x_si", "y_si")
    x = F.col("x_si")
    in_range = (x > 0) & (x < 2e9)  # a bin is an int; no temperature lies beyond
    rows = rows.filter((F.col("property_id_x") == 1) & in_range).withColumn("t_bin_k", F.when(in_range, (F.floor(x / 10) * 10).cast("int")))
    return wide.widen(rows.filter("t_bin_k > 0"), ["paper_id", "sample_id", "t_bin_k"], "property_id_y", "y_si", STATE_ATTRIBUTES)


def p3_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table, means rounded to 12 decimals so that the order of sums does not show."""
    w = _wide(spark, sf_dir)
    return w.select("paper_id", "sample_id", "t_bin_k", *(c for a in STATE_ATTRIBUTES for c in (F.round(a.name, 12).alias(a.name), F.col(f"n_{a.name}"))))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide rows that have Seebeck, conductivity and thermal conductivity."""
    full = _wide(spark, sf_dir).filter("seebeck IS NOT NULL AND conductivity IS NOT NULL AND thermal_conductivity IS NOT NULL")
    return full.select("paper_id", "sample_id", "t_bin_k")


# ---- p4: too many small files ---------------------------------------------------------------------------------------

TARGET_BYTES = 128 << 20


def _compacted_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, compact.Compaction]:
    records = written(compact.delivered_records(table(spark, sf_dir, "raw_files")), "records")
    done = compact.compact(records, scratch_path(spark, "compacted"), compact.RECORD_FIELDS, ("file_id", "rec_pos"), TARGET_BYTES)
    return spark.read.schema(records.schema).parquet(done.path), done


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the consolidated table that repeat one delivered before."""
    records, _ = _compacted_records(spark, sf_dir)
    return compact.repeated_records(records).select("file_id", "rec_pos")


def p4_records_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidate every record once into sorted files, and count what is stored per paper after the swap."""
    records, _ = _compacted_records(spark, sf_dir)
    done = compact.compact(compact.records_once(records), scratch_path(spark, "once"), compact.RECORD_FIELDS, ("file_id", "rec_pos"), TARGET_BYTES)
    stored = spark.read.schema(records.schema).parquet(done.path)
    return stored.groupBy("paperid").agg(F.count(F.lit(1)).alias("n_records"), F.countDistinct("file_id").alias("n_files"), F.min("file_id").alias("first_file"), F.sum("rec_pos").alias("sum_rec_pos"))


def p4_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidate the measurements of all source files, and count what is stored per paper after the swap."""
    facts = table(spark, sf_dir, "fact_measurements")
    done = compact.compact(facts, scratch_path(spark, "facts"), ("paper_id", "source_file"), ("measurement_id",), TARGET_BYTES)
    stored = spark.read.schema(facts.schema).parquet(done.path)
    return stored.groupBy("paper_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("source_file").alias("n_source_files"), F.min("measurement_id").alias("first_id"), F.max("measurement_id").alias("last_id")
    )


# ---- p5: references to records that do not exist --------------------------------------------------------------------

REFERENCES = (
    orphans.Reference("fact_measurements", "measurement_id", "paper_id", ("paper_id",), "dim_papers", ("paper_id",)),
    orphans.Reference("fact_measurements", "measurement_id", "sample_id", ("sample_id", "paper_id"), "dim_samples", ("sample_id", "paper_id")),
    orphans.Reference("fact_measurements", "measurement_id", "figure_id", ("figure_id", "paper_id"), "dim_figures", ("figure_id", "paper_id")),
    orphans.Reference("dim_figures", "row_id", "property_id_y", ("property_id_y",), "dim_properties", ("property_id",)),
)


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = {n: table(spark, sf_dir, n) for n in ("fact_measurements", "dim_figures")}
    parents = {n: table(spark, sf_dir, n) for n in ("dim_papers", "dim_samples", "dim_figures", "dim_properties")}
    return orphans.find_orphans(children, parents, REFERENCES)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every orphan reference: child table, column and row."""
    return _orphans(spark, sf_dir).select("child_table", "child_column", "child_id")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per child table, column and month."""
    return orphans.orphan_report(_orphans(spark, sf_dir))


# ---- p6: schemas that drift -----------------------------------------------------------------------------------------

UNIFIED_FIELDS = ("paperid", "sampleid", "figureid", "propertyid_x", "propertyid_y", "x", "y")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field changes of each file against the one before it in its feed."""
    return drift.field_changes(drift.change_scripts(table(spark, sf_dir, "raw_files")))


def p6_script_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each step of the change scripts occurs: adds, deletions, renames, moves and retypings."""
    scripts = drift.change_scripts(table(spark, sf_dir, "raw_files"))
    return scripts.groupBy("op", "old_path", "new_path").agg(F.count(F.lit(1)).alias("n_files"), F.countDistinct("feed").alias("n_feeds"))


def p6_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of all files in one consistent table, by the compiled projections."""
    raw = table(spark, sf_dir, "raw_files")
    projection = drift.compile_projection(drift.change_scripts(raw), raw)
    return drift.unified_records(raw, projection, UNIFIED_FIELDS)


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_steps, p1_records, p3_found, p3_wide, p4_found, p4_records_once, p4_compaction, p5_found, p5_report, p6_found, p6_script_steps, p6_unified)
}

_LIVE = "p.ingested_at <= c.ingested_at AND (p.deleted_at IS NULL OR p.deleted_at > c.ingested_at)"
_ORPHANS = f"""
SELECT 'fact_measurements' AS child_table, 'paper_id' AS child_column, measurement_id AS child_id, c.ingested_at AS at_time FROM fact_measurements c
 WHERE paper_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_papers p WHERE p.paper_id = c.paper_id AND {_LIVE})
UNION ALL
SELECT 'fact_measurements', 'sample_id', measurement_id, c.ingested_at FROM fact_measurements c
 WHERE sample_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_samples p WHERE p.sample_id = c.sample_id AND p.paper_id = c.paper_id AND {_LIVE})
UNION ALL
SELECT 'fact_measurements', 'figure_id', measurement_id, c.ingested_at FROM fact_measurements c
 WHERE figure_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_figures p WHERE p.figure_id = c.figure_id AND p.paper_id = c.paper_id AND {_LIVE})
UNION ALL
SELECT 'dim_figures', 'property_id_y', row_id, c.ingested_at FROM dim_figures c
 WHERE property_id_y IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_properties p WHERE p.property_id = c.property_id_y AND {_LIVE})
"""
_WIDE = """
SELECT paper_id, sample_id, CAST(floor(x_si / 10) * 10 AS INTEGER) AS t_bin_k,
       avg(CASE WHEN property_id_y = 2 THEN y_si END) AS seebeck,
       count(CASE WHEN property_id_y = 2 THEN y_si END) AS n_seebeck,
       avg(CASE WHEN property_id_y = 3 AND y_si > 0 THEN y_si WHEN property_id_y = 5 AND y_si > 0 THEN 1 / y_si END) AS conductivity,
       count(CASE WHEN property_id_y IN (3, 5) AND y_si > 0 THEN y_si END) AS n_conductivity,
       avg(CASE WHEN property_id_y IN (4, 14) THEN y_si END) AS thermal_conductivity,
       count(CASE WHEN property_id_y IN (4, 14) THEN y_si END) AS n_thermal_conductivity,
       avg(CASE WHEN property_id_y = 5 AND y_si > 0 THEN y_si END) AS resistivity,
       count(CASE WHEN property_id_y = 5 AND y_si > 0 THEN y_si END) AS n_resistivity,
       avg(CASE WHEN property_id_y = 16 THEN y_si END) AS figure_of_merit,
       count(CASE WHEN property_id_y = 16 THEN y_si END) AS n_figure_of_merit
FROM fact_measurements
WHERE property_id_x = 1 AND x_si > 0 AND isfinite(x_si) AND isfinite(y_si) AND floor(x_si / 10) * 10 > 0
GROUP BY ALL
"""


def _doc_sql(c: str) -> str:
    inner = f"json_extract_string({c}, '$')"
    return f"CASE WHEN json_valid({c}) THEN CASE json_type({c}) WHEN 'OBJECT' THEN {c} WHEN 'VARCHAR' THEN CASE WHEN json_valid({inner}) THEN CASE WHEN json_type({inner}) = 'OBJECT' THEN {inner} END END END END"


def _elements_sql(src: str, columns: str, array: str, pos: str) -> str:
    """Rows of ``src`` with each object of an array expression and its place; a lone object is an array of one."""
    return f"""SELECT {columns}, CAST({pos} AS INTEGER) AS {pos}, json_extract(arr, concat('$[', {pos}, ']')) AS el FROM (
      SELECT *, unnest(range(CAST(json_array_length(arr) AS BIGINT))) AS {pos} FROM (SELECT *, CASE json_type({array}) WHEN 'ARRAY' THEN {array} WHEN 'OBJECT' THEN json_array({array}) END AS arr FROM ({src})) WHERE arr IS NOT NULL)
      WHERE json_type(json_extract(arr, concat('$[', {pos}, ']'))) = 'OBJECT'"""


_SAMPLE_DOCS = f"SELECT row_id AS parent_id, {_doc_sql('sampleinfo_json')} AS doc FROM dim_samples"
_FILE_DOCS = f"SELECT file_id AS parent_id, feed, exported_at, {_doc_sql('payload')} AS doc FROM raw_files"


def _branches_sql() -> str:
    parts = []
    for origin, docs, branches in (("dim_samples", _SAMPLE_DOCS, SAMPLE_BRANCHES), ("raw_files", _FILE_DOCS, FILE_BRANCHES)):
        for b in branches:
            parent = b.rpartition(".")[0]
            outer = parent if parent in branches else b
            rows = _elements_sql(docs, "parent_id", f"json_extract(doc, '$.{outer}')", "outer_pos")
            if outer == b:
                parts.append(f"SELECT '{origin}' AS origin, parent_id, '{b}' AS branch, outer_pos, CAST(-1 AS INTEGER) AS inner_pos FROM ({rows})")
            else:
                inner = _elements_sql(f"SELECT parent_id, outer_pos, el AS owner FROM ({rows})", "parent_id, outer_pos", f"json_extract(owner, '$.{b.rpartition('.')[2]}')", "inner_pos")
                parts.append(f"SELECT '{origin}' AS origin, parent_id, '{b}' AS branch, outer_pos, inner_pos FROM ({inner})")
    return " UNION ALL ".join(parts)


def _number_sql(field: str) -> str:
    v = f"json_extract(el, '$.{field}')"
    return f"CASE WHEN json_type({v}) IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(trim(json_extract_string(el, '$.{field}')) AS DOUBLE) END"


def _steps_sql() -> str:
    text = lambda f, o: f"CASE WHEN json_type({o}, '$.{f}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string({o}, '$.{f}') END"
    steps = _elements_sql(_SAMPLE_DOCS, "parent_id", "json_extract(doc, '$.FabricationProcess.steps')", "outer_pos")
    owners = f"SELECT parent_id, outer_pos, el AS owner, {text('name', 'el')} AS step_name, {text('atmosphere', 'el')} AS atmosphere FROM ({steps})"
    inner = _elements_sql(owners, "parent_id, outer_pos, step_name, atmosphere", "json_extract(owner, '$.conditions')", "inner_pos")
    return f"SELECT parent_id AS row_id, outer_pos AS step_pos, inner_pos AS condition_pos, step_name, atmosphere, {text('param', 'el')} AS param, TRY_CAST({text('value', 'el')} AS DOUBLE) AS value, {text('unit', 'el')} AS unit FROM ({inner})"


_RAW = "json_extract(doc, '$.rawdata')"
_RECORDS = "SELECT parent_id AS file_id, outer_pos AS rec_pos, " + ", ".join(f"{_number_sql(f)} AS {f}" for f in FILE_BRANCHES["rawdata"]) + f" FROM ({_elements_sql(_FILE_DOCS, 'parent_id', _RAW, 'outer_pos')})"
_KIND = "CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END"
_POINTS = "json_extract(doc, '$.data_points')"
_OBJECTS = " UNION ALL ".join(f"SELECT parent_id, el FROM ({_elements_sql(_FILE_DOCS, 'parent_id', a, 'pos')})" for a in (_RAW, _POINTS))
_FIELD_CHANGES = f"""
WITH docs AS ({_FILE_DOCS}), objects AS ({_OBJECTS}), files AS (SELECT parent_id, feed, exported_at FROM docs WHERE parent_id IN (SELECT parent_id FROM objects)),
 fields AS (SELECT parent_id, path, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kinds FROM (
   SELECT d.parent_id, concat('root.', e.key) AS path, {_KIND} AS kind FROM docs d, json_each(d.doc) e WHERE d.doc IS NOT NULL AND e.type <> 'NULL'
   UNION ALL SELECT o.parent_id, concat('record.', e.key), {_KIND} FROM objects o, json_each(o.el) e WHERE e.type <> 'NULL') GROUP BY ALL),
 pairs AS (SELECT parent_id AS b, lag(parent_id) OVER (PARTITION BY feed ORDER BY exported_at, parent_id) AS a FROM files)
SELECT p.b AS file_id, f.path AS field_path, 'removed' AS change_kind FROM pairs p JOIN fields f ON f.parent_id = p.a WHERE NOT EXISTS (SELECT 1 FROM fields g WHERE g.parent_id = p.b AND g.path = f.path)
UNION ALL SELECT p.b, f.path, 'added' FROM pairs p JOIN fields f ON f.parent_id = p.b WHERE p.a IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fields g WHERE g.parent_id = p.a AND g.path = f.path)
UNION ALL SELECT p.b, f.path, 'retyped' FROM pairs p JOIN fields f ON f.parent_id = p.b JOIN fields g ON g.parent_id = p.a AND g.path = f.path WHERE g.kinds <> f.kinds
"""

ORACLE = {
    "p1_found": _branches_sql(),
    "p1_records": _RECORDS,
    "p1_steps": _steps_sql(),
    "p3_wide": f"SELECT paper_id, sample_id, t_bin_k, {', '.join(f'round({a.name}, 12) AS {a.name}, n_{a.name}' for a in STATE_ATTRIBUTES)} FROM ({_WIDE}) WHERE n_seebeck + n_conductivity + n_thermal_conductivity + n_resistivity + n_figure_of_merit > 0",
    "p4_found": "SELECT file_id, rec_pos FROM (" + _RECORDS + ") WHERE " + " AND ".join(f"isfinite({f})" for f in compact.RECORD_FIELDS) + f" QUALIFY row_number() OVER (PARTITION BY {', '.join(compact.RECORD_FIELDS)} ORDER BY file_id, rec_pos) > 1",
    "p4_records_once": f"SELECT CASE WHEN isfinite(paperid) THEN paperid END AS paperid, count(*) AS n_records, count(DISTINCT file_id) AS n_files, min(file_id) AS first_file, CAST(sum(rec_pos) AS BIGINT) AS sum_rec_pos FROM (SELECT * FROM ({_RECORDS}) QUALIFY NOT ("
    + " AND ".join(f"coalesce(isfinite({f}), false)" for f in compact.RECORD_FIELDS)
    + f") OR row_number() OVER (PARTITION BY {', '.join(compact.RECORD_FIELDS)} ORDER BY file_id, rec_pos) = 1) GROUP BY 1",
    "p6_found": _FIELD_CHANGES,
    "p3_found": f"SELECT paper_id, sample_id, t_bin_k FROM ({_WIDE}) WHERE seebeck IS NOT NULL AND conductivity IS NOT NULL AND thermal_conductivity IS NOT NULL",
    "p4_compaction": "SELECT paper_id, count(*) AS n_records, count(DISTINCT source_file) AS n_source_files, min(measurement_id) AS first_id, max(measurement_id) AS last_id FROM fact_measurements GROUP BY paper_id",
    "p5_found": f"SELECT child_table, child_column, child_id FROM ({_ORPHANS})",
    "p5_report": f"SELECT child_table, child_column, strftime(at_time, '%Y-%m') AS month, count(*) AS n_orphans FROM ({_ORPHANS}) GROUP BY ALL",
}
