"""Reading corpora of JSON files: strict and lenient scans, counts, and the nested schema."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics, text
from kelvinlake.session import absolute_uri, filesystem

#: Ids are read as text, since sources give numbers or digits; see ``text.flexible_id``.
SCHEMA = (
    "sample array<struct<sampleid:string,paperid:string,samplename:string,composition:string,sampleinfo:string>>, "
    "paper array<struct<paperid:string,doi:string,title:string,author:string,author_full:string,journal:string,journal_full:string,year:string,volume:string,pages:string,publisher:string,url:string>>, "
    "property array<struct<propertyid:string,propertyname:string,unit:string>>, "
    "figure array<struct<figureid:string,paperid:string,figurename:string,caption:string,propertyid_x:string,propertyid_y:string>>, "
    "rawdata array<struct<paperid:string,sampleid:string,figureid:string,x:string,y:string,propertyid_x:string,propertyid_y:string>>, "
    "_corrupt string"
)
REQUIRED = ("paperid", "sampleid", "figureid", "propertyid_x", "propertyid_y")
ARRAYS = ("sample", "paper", "property", "figure", "rawdata")


def shard_paths(spark: SparkSession, root: str) -> list[str]:
    """Direct sub-folders in order; the root itself if there are none (files beside sub-folders are not read)."""
    fs, path = filesystem(spark, root)
    if not fs.exists(path):
        raise FileNotFoundError(root)
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isDirectory()) or [root]


def scan_domain(spark: SparkSession, root: str, domain: str, recursive: bool = False) -> DataFrame:
    """One row per JSON file of a domain, with its arrays, its counts, and why it was refused, if it was.

    Files end in ``.json``. A file that cannot be parsed, or in which a measurement lacks a required id or number, is kept as
    a row with ``error`` set and empty arrays: one bad file fails neither the others nor the scan. A file is one row whatever
    it holds: empty, blank, and those whose document is no object are unreadable. The schema is given, so files are read once.
    """
    paths = [root] if recursive else shard_paths(spark, root)
    reader = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", recursive)
    whole = reader.text(paths, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("__text"), F.col("_metadata.file_path").alias("source_file"))
    # Spark's readers skip files of no bytes; they are rows as any others.
    df = whole.unionByName(_empty_files(spark, paths, recursive).withColumn("__text", F.lit("")))
    shape = T._parse_datatype_string(SCHEMA)
    df = df.withColumn("__d", F.from_json("__text", SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    df = df.withColumns({f.name: F.col(f"__d.{f.name}") for f in shape} | {"__readable": F.col("__d").isNotNull() & F.col("__d._corrupt").isNull()})
    valid = F.forall("rawdata", lambda m: F.coalesce(m["x"].try_cast("double").isNotNull() & m["y"].try_cast("double").isNotNull(), F.lit(False)) & _ids_ok(m))
    error = F.when(~F.col("__readable"), "UNREADABLE").when(~F.coalesce(valid, F.lit(True)), "FIELD_MISSING")
    out = df.withColumns({"source_domain": F.lit(domain), "error": error})
    empty = {a: F.when(F.col("error").isNull(), F.coalesce(F.col(a), F.array().cast(shape[a].dataType))).otherwise(F.array().cast(shape[a].dataType)) for a in ARRAYS}
    return out.withColumns(empty).select(*ARRAYS, "source_file", "source_domain", "error")


def _empty_files(spark: SparkSession, paths: list[str], recursive: bool) -> DataFrame:
    """(source_file) of the JSON files of no bytes in the folders, listed by the executors, one folder at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                uri = absolute_uri(path)
                system, folder = pafs.FileSystem.from_uri(quote(uri, safe=":/"))
                listed = system.get_file_info(pafs.FileSelector(folder, recursive=recursive))
                names = [uri.removesuffix(folder) + quote(f.path) for f in listed if f.type == pafs.FileType.File and f.size == 0 and f.base_name.endswith(".json")]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["source_file"])

    folders = spark.createDataFrame([(p,) for p in paths], "path string")
    return folders.repartition(min(len(paths), spark.sparkContext.defaultParallelism)).mapInArrow(run, "source_file string")


def _ids_ok(m: Column) -> Column:
    ok = F.lit(True)
    for f in REQUIRED:
        ok = ok & text.flexible_id(m[f]).isNotNull()
    return ok


def measurements(files: DataFrame) -> DataFrame:
    """Points of all files: finite, of allowed properties, with the flag for a figure that the file does not list."""
    m = files.select("source_file", "source_domain", F.transform("figure", lambda f: text.flexible_id(f["figureid"])).alias("figures"), F.posexplode("rawdata").alias("position", "m"))
    ids = {name: text.flexible_id(F.col(f"m.{c}")) for name, c in (("paper_id", "paperid"), ("sample_id", "sampleid"), ("figure_id", "figureid"), ("property_id_x", "propertyid_x"), ("property_id_y", "propertyid_y"))}
    points = m.withColumns(ids | {c: F.expr(f"try_cast(m.{c} AS double)") for c in ("x", "y")})
    good = points.filter(physics.finite(F.col("x")) & physics.finite(F.col("y")) & F.col("property_id_y").isin(*K.ALLOWED_PROPERTIES))
    flag = F.when(F.array_contains("figures", F.col("figure_id")), 0).otherwise(K.BIT["FIGUREID_MISMATCH"])
    return good.withColumn("anomaly_flags", flag).drop("m", "figures")


def samples(files: DataFrame) -> DataFrame:
    """Sample rows with the eight categories of their free-form description."""
    keys = {"material_family": "MaterialFamily", "form": "Form", "fabrication_process": "FabricationProcess", "relative_density": "RelativeDensity", "grain_size": "GrainSize", "data_type": "DataType", "thermal_measurement": "ThermalMeasurement", "electrical_measurement": "ElectricalMeasurement"}
    s = files.select("source_file", "source_domain", F.posexplode("sample").alias("position", "s"))
    info = F.col("s.sampleinfo")
    return s.select(
        "source_file", "source_domain", "position", text.flexible_id(F.col("s.sampleid")).alias("sample_id"), text.flexible_id(F.col("s.paperid")).alias("paper_id"),
        F.coalesce("s.samplename", F.lit("")).alias("samplename"), F.coalesce("s.composition", F.lit("")).alias("composition"),
        *(text.sampleinfo_category(info, k).alias(name) for name, k in keys.items()), F.coalesce(info, F.lit("{}")).alias("sampleinfo_json"),
    )


def papers(files: DataFrame) -> DataFrame:
    p = files.select("source_file", "source_domain", F.posexplode("paper").alias("position", "p"))
    names = ("doi", "title", "author", "author_full", "journal", "journal_full", "volume", "pages", "publisher", "url")
    year = F.coalesce(F.expr("try_cast(p.year AS smallint)"), F.lit(0).cast("smallint"))
    return p.select("source_file", "source_domain", "position", text.flexible_id(F.col("p.paperid")).alias("paper_id"), *(F.coalesce(F.col(f"p.{n}"), F.lit("")).alias(n) for n in names), year.alias("year"))


def properties(files: DataFrame) -> DataFrame:
    p = files.select("source_file", F.explode("property").alias("p"))
    return p.select(text.flexible_id(F.col("p.propertyid")).alias("property_id"), F.coalesce("p.propertyname", F.lit("")).alias("propertyname"), F.coalesce("p.unit", F.lit("")).alias("unit")).distinct()


def figures(files: DataFrame) -> DataFrame:
    f = files.select("source_file", "source_domain", F.posexplode("figure").alias("position", "f"))
    ids = {n: text.flexible_id(F.col(f"f.{c}")) for n, c in (("figure_id", "figureid"), ("paper_id", "paperid"), ("property_id_x", "propertyid_x"), ("property_id_y", "propertyid_y"))}
    return f.select("source_file", "source_domain", "position", *(c.alias(n) for n, c in ids.items()), F.coalesce("f.figurename", F.lit("")).alias("figurename"), F.coalesce("f.caption", F.lit("")).alias("caption"))


def scan_summary(files: DataFrame) -> DataFrame:
    """Counters of a scan: files read and failed, records per array, points kept and refused, figure mismatches."""
    figures_of = F.transform("figure", lambda f: text.flexible_id(f["figureid"]))
    good = lambda m: physics.finite(m["x"].try_cast("double")) & physics.finite(m["y"].try_cast("double")) & text.flexible_id(m["propertyid_y"]).isin(*K.ALLOWED_PROPERTIES)
    kept = F.filter("rawdata", good)
    return files.groupBy("source_domain").agg(
        F.count(F.lit(1)).alias("files_seen"), F.count("error").alias("files_failed"), *(F.sum(F.size(a)).alias(f"n_{a}") for a in ARRAYS),
        F.sum(F.size(kept)).alias("n_kept"), F.sum(F.size("rawdata") - F.size(kept)).alias("n_rejected"),
        F.sum(F.size(F.filter(kept, lambda m: ~F.array_contains(figures_of, text.flexible_id(m["figureid"]))))).alias("n_figure_mismatch"),
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of the JSON files of a corpus, contents unread."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(root).select("path", "length")


def count_by_property(spark: SparkSession, root: str) -> DataFrame:
    """Raw points per property over a whole tree, before any filter."""
    files = scan_domain(spark, root, "all", recursive=True)
    return files.select(F.explode("rawdata").alias("m")).groupBy(text.flexible_id(F.col("m.propertyid_y")).alias("property_id_y")).agg(F.count(F.lit(1)).alias("n_points"))


def two_shape_points(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Points of documents of either shape: ``data_points`` if there, else ``rawdata``; ids local or of the root; finite numbers or numeric text only."""
    shape = "sample_id string, data_points array<struct<sampleid:string,sample_id:string,x:string,y:string>>, rawdata array<struct<sampleid:string,sample_id:string,x:string,y:string>>"
    d = raw.withColumn("__d", F.from_json(payload, shape)).filter("__d IS NOT NULL")
    p = d.select(*raw.drop(payload).columns, F.col("__d.sample_id").alias("__root"), F.posexplode(F.coalesce("__d.data_points", "__d.rawdata")).alias("position", "__p"))
    sample = F.coalesce("__p.sampleid", "__p.sample_id", "__root")
    out = p.withColumns({"sample_id": text.flexible_id(sample), "x": F.expr("try_cast(__p.x AS double)"), "y": F.expr("try_cast(__p.y AS double)")})
    return out.filter(physics.finite(F.col("x")) & physics.finite(F.col("y"))).drop("__p", "__root")


def lenient_points(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Points of documents read leniently: an object, or a list of objects, with ``rawdata``; nothing is refused as a whole.

    A point without a property id is passed over; one of a property that is not allowed has ``allowed`` false and is only
    there to be counted. propertyid_x is 1 where it is missing. Texts that cannot be read give no points. Columns: those of
    ``raw`` but the payload, entry, position, the ids as whole numbers, x and y as doubles or null, allowed.
    """
    point = "struct<paperid:string,sampleid:string,figureid:string,x:string,y:string,propertyid_x:string,propertyid_y:string>"
    lists = F.from_json(payload, f"array<struct<rawdata:array<{point}>>>")
    one = F.from_json(payload, f"struct<rawdata:array<{point}>>")
    is_list = F.ltrim(F.col(payload)).startswith("[")
    d = raw.filter(F.try_parse_json(payload).isNotNull()).withColumn("__d", F.when(is_list, lists).otherwise(F.array(one)))
    e = d.select(*raw.drop(payload).columns, F.posexplode("__d").alias("entry", "__e"))
    p = e.select(*raw.drop(payload).columns, "entry", F.posexplode("__e.rawdata").alias("position", "__p")).filter("__p.propertyid_y IS NOT NULL")
    ids = {n: text.flexible_id(F.col(f"__p.{c}")) for n, c in (("paper_id", "paperid"), ("sample_id", "sampleid"), ("figure_id", "figureid"), ("property_id_y", "propertyid_y"))}
    out = p.withColumns(ids | {"property_id_x": F.coalesce(text.flexible_id(F.col("__p.propertyid_x")), F.lit(1).cast("long")), "x": F.expr("try_cast(__p.x AS double)"), "y": F.expr("try_cast(__p.y AS double)")})
    return out.withColumn("allowed", F.coalesce(F.col("property_id_y").isin(*K.ALLOWED_PROPERTIES), F.lit(False))).drop("__p")
