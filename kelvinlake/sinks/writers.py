"""Writing results: Parquet exports, publication rows, bad records, reports, manifests and databases."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvinlake.functions import physics
from kelvinlake.session import absolute_uri, filesystem, swap_folders


def export_tables(tables: Mapping[str, DataFrame], root: str, level: int = 9) -> dict[str, str]:
    """Full rebuild of named tables as ZSTD Parquet folders."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{name}.parquet"
        df.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(paths[name])
    return paths


PUBLICATION = (
    ("sample_id", "long"), ("composition", "string"), ("paper_id", "long"), ("property_x", "string"), ("property_y", "string"), ("unit_x", "string"), ("unit_y", "string"),
    ("x", "double"), ("y", "double"), ("confidence_tier", "int"), ("anomaly_flags", "int"), ("zt_computed", "double"), ("kappa_lattice", "double"), ("lorenz_number", "double"), ("zt_cross_check_error", "double"),
)


def publication_rows(audited: DataFrame) -> DataFrame:
    """The 15 fields of the publication dataset with their defaults; values that are not finite become null."""
    have = set(audited.columns)
    source = {"confidence_tier": "audit_tier", "zt_cross_check_error": "zt_error"}
    default = {"composition": F.lit("unknown"), "paper_id": F.lit(0), "x": F.lit(0.0), "y": F.lit(0.0)}

    def column(name: str, kind: str) -> Column:
        src = source.get(name, name)
        c = F.col(src).cast(kind) if src in have else F.lit(None).cast(kind)
        if kind == "double":
            c = physics.null_if_not_finite(c)
        fallback = default.get(name, F.lit("") if kind == "string" else None)
        return (F.coalesce(c, fallback.cast(kind)) if fallback is not None else c).alias(name)

    return audited.select(*(column(n, k) for n, k in PUBLICATION))


def write_json_files(rows: DataFrame, root: str, shards: int = 16) -> int:
    """Write (id, text) rows as one file ``<root>/s<id mod shards>/<id>.json`` each, a null text as an empty file; returns the number of files.

    Ids are unique whole numbers; the executors write, and a task run again writes the same files again.
    """
    uri = absolute_uri(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        system, base = pafs.FileSystem.from_uri(quote(uri, safe=":/"))
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folder = f"{base}/s{i % shards:04d}"
                if folder not in made:
                    system.create_dir(folder)
                    made.add(folder)
                with system.open_output_stream(f"{folder}/{i}.json", compression=None) as out:
                    out.write((text or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    made: set[str] = set()
    one = rows.select(*rows.columns[:2]).mapInArrow(run, "n long").agg(F.sum("n").alias("n")).first()
    return one["n"] or 0


def write_checked(df: DataFrame, path: str, expected: T.StructType, compression: str = "snappy") -> int:
    """Cast to the expected schema or fail, write to a temporary folder, then swap; returns the row count.

    The table before stays beside the new one until that is in place, and is put back if it cannot be.
    """
    spark = df.sparkSession
    if set(df.columns) != set(expected.names):
        raise ValueError(f"columns {sorted(df.columns)}, not {sorted(expected.names)}")
    staged = f"{path}.staging"
    df.select(*(F.col(f.name).cast(f.dataType) for f in expected)).write.mode("overwrite").option("compression", compression).parquet(staged)
    swap_folders(spark, staged, path)
    return spark.read.parquet(path).count()


def bad_records(states: DataFrame) -> DataFrame:
    """Rejected or flagged states with decoded flags and the stage that refused them."""
    f = F.col("anomaly_flags")
    stage = F.when(physics.has_flag(f, "ALGEBRAIC_REJECT"), "gate_1").when(physics.has_flag(f, "WF_VIOLATION"), "gate_2").when(physics.has_flag(f, "ZT_CROSSCHECK_FAIL"), "gate_3").when(physics.has_flag(f, "TEMPERATURE_OUT_OF_RANGE"), "temperature").when(F.col("audit_tier") == 4, "incomplete").otherwise("other")
    return states.filter((F.col("audit_tier") == 4) | (f != 0)).withColumns({"rejection_stage": stage, "reasons": F.array_join(physics.decode_flags(f), "|")})


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, in as many files as there are tasks."""
    df.write.mode("overwrite").json(path)


def write_json_summary(one_row: DataFrame, path: str) -> dict:
    """A one-row aggregate as a JSON file with sorted keys, replaced at once."""
    row = one_row.limit(2).collect()
    if len(row) != 1:
        raise ValueError("a summary is one row")
    out = row[0].asDict(recursive=True)
    temporary = Path(f"{path}.tmp")
    temporary.write_text(json.dumps(out, sort_keys=True, indent=1, default=str))
    temporary.replace(path)
    return out


def markdown_table(df: DataFrame, title: str, most: int = 200) -> str:
    """A small aggregate as a Markdown section; more rows than ``most`` is an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{title}: more than {most} rows")
    show = lambda v: "" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " - |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(show(v) for v in r) + " |" for r in rows), ""])


def write_report(path: str, title: str, sections: Mapping[str, DataFrame]) -> str:
    body = f"# {title}\n\n" + "\n".join(markdown_table(df, name) for name, df in sections.items())
    Path(path).write_text(body)
    return body


def append_manifest(files: DataFrame, path: str, run: str) -> None:
    """Record processed files, so that a later run can leave them out."""
    files.select("source_file").distinct().withColumns({"run": F.lit(run), "done_at": F.current_timestamp()}).write.mode("append").parquet(path)


def unprocessed(spark: SparkSession, files: DataFrame, manifest: str) -> DataFrame:
    fs, path = filesystem(spark, manifest)
    if not fs.exists(path):
        return files
    return files.join(spark.read.parquet(manifest).select("source_file").distinct(), "source_file", "left_anti")


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **properties: str) -> None:
    """Bulk insert in batches, each partition in one serializable transaction."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), isolationLevel="SERIALIZABLE", **properties).mode("append").save()


def material_nodes(df: DataFrame, key: str) -> DataFrame:
    """The node table of materials: one row per key, merged, with a stable id."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("node_id", F.sha2(F.col(key), 256))


def drift_between(source: DataFrame, sink: DataFrame, key: str) -> DataFrame:
    """Keys that one of two sinks lacks after a write."""
    a, b = source.select(key).distinct(), sink.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("missing_in", F.lit("sink")).unionByName(b.join(a, key, "left_anti").withColumn("missing_in", F.lit("source")))
