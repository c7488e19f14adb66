"""Consolidating very many small files into few sorted files of a target size."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvinlake.operators.json_tree import as_elements, parse_document
from kelvinlake.session import filesystem, swap_folders


@dataclass(frozen=True)
class Compaction:
    """What a compaction did: rows, an order-free checksum, and the number of files."""

    path: str
    rows: int
    checksum: int
    files: int


def _row_bytes(df: DataFrame) -> Column:
    """Estimated stored bytes of a row: text lengths, 8 for other scalars, JSON length for nested values."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = F.lit(0).cast("long")
    for p in parts:
        total = total + p
    return total


def _fingerprint(df: DataFrame) -> Column:
    """Order-free checksum: the sum of row hashes, in a type that cannot overflow."""
    return F.coalesce(F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


#: Files are not cut smaller than this to keep the cores busy.
LEAST_BYTES = 1 << 20


def compact(df: DataFrame, out: str, keys: Sequence[str], tie: Sequence[str], target_bytes: int = 128 << 20, least_bytes: int = LEAST_BYTES) -> Compaction:
    """Write ``df`` to the folder ``out`` as few files of about ``target_bytes``, sorted by ``keys`` then ``tie``.

    Tables of fewer such files than there are cores are written as one file per core, down to ``least_bytes`` each.

    Rows are range-partitioned with boundaries sampled from (keys, tie); ``tie`` should make rows distinct, so that a
    hot key is split over several files instead of landing in one. Files go to a staging folder first; row
    count and checksum of what was written are reconciled with the input, and only then are the folders swapped. If
    they differ, the staging folder is removed, ``out`` stays as it was, and ValueError is raised.
    Nulls sort first; equal rows are all kept; an empty input gives an empty table with its schema.
    """
    spark = df.sparkSession
    before = df.agg(F.count(F.lit(1)).alias("n"), _fingerprint(df).alias("f"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    files = max(1, math.ceil(before["b"] / target_bytes), min(spark.sparkContext.defaultParallelism, before["b"] // min(least_bytes, target_bytes)))
    order = [*keys, *tie]
    staging = f"{out}.staging"
    ordered = df.repartitionByRange(files, *order).sortWithinPartitions(*order) if before["n"] else df.coalesce(1)
    ordered.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    back = spark.read.schema(df.schema).parquet(staging)
    after = back.agg(F.count(F.lit(1)).alias("n"), _fingerprint(back).alias("f")).first()
    fs, staged = filesystem(spark, staging)
    if (after["n"], after["f"]) != (before["n"], before["f"]):
        fs.delete(staged, True)
        raise ValueError(f"compaction of {out}: {before['n']} rows in, {after['n']} rows written, checksums {before['f']} and {after['f']}")
    swap_folders(spark, staging, out)
    return Compaction(out, before["n"], int(before["f"]), len(spark.read.schema(df.schema).parquet(out).inputFiles()))


RECORD_FIELDS = ("paperid", "propertyid_x", "propertyid_y", "x", "y")
RECORD_SCHEMA = "file_id long, rec_pos int, paperid double, propertyid_x double, propertyid_y double, x double, y double, record string"


def as_number(value) -> float | None:
    """A JSON number, or text that is one, as a double; anything else, and what is not finite, is None."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, str):
        if "_" in value:
            return None
        value = value.strip()
    elif not isinstance(value, (int, float)):
        return None
    try:
        number = float(value)
    except (ValueError, OverflowError):
        return None
    return number + 0.0 if math.isfinite(number) else None


def delivered_records(raw_files: DataFrame) -> DataFrame:
    """One row per object in ``rawdata`` of each payload: its place, its five numbers, and its whole JSON text."""
    arrow = pa.schema([("file_id", pa.int64()), ("rec_pos", pa.int32()), *((f, pa.float64()) for f in RECORD_FIELDS), ("record", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                document = parse_document(text)
                if document is None or file_id is None:
                    continue
                for pos, item in enumerate(as_elements(document.get("rawdata"))):
                    if isinstance(item, dict):
                        rows.append((file_id, pos, *(as_number(item.get(f)) for f in RECORD_FIELDS), json.dumps(item, ensure_ascii=True)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    return raw_files.select(F.col("file_id").cast("long"), "payload").mapInArrow(run, RECORD_SCHEMA)


def repeated_records(records: DataFrame, keys: Sequence[str] = RECORD_FIELDS, order: Sequence[str] = ("file_id", "rec_pos")) -> DataFrame:
    """Rows of ``order`` whose five key values all occur at a lower place; a record with a null key is never one.

    The first place of each key comes from a map-side combined minimum (a hot key shrinks before the shuffle; in
    compacted, sorted files equal keys already lie together). Its place identifies a row, so the rest is an anti
    join on the unique place, not on the skewed key.
    """
    whole = records.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)).withColumn("__place", _place(*order))
    firsts = whole.groupBy(*keys).agg(F.min("__place").alias("__place")).select("__place")
    return whole.join(firsts, "__place", "left_anti").select(*order)


def records_once(records: DataFrame, order: Sequence[str] = ("file_id", "rec_pos")) -> DataFrame:
    """The records without those that repeat one at a lower place; records that cannot be compared are all kept."""
    return records.join(repeated_records(records, order=order), list(order), "left_anti")


def _place(major: str, minor: str) -> Column:
    """A long and an int as one number in the order of both, which a hash aggregation can take the minimum of."""
    return F.col(major).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col(minor).cast("decimal(11,0)")
