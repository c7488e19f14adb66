"""Incremental ingest with Structured Streaming: file batches, resume, deduplication, running statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def clean_points(points: DataFrame) -> DataFrame:
    """The narrow filters of the ingest, the same on streams and batches."""
    return points.filter(physics.finite(F.col("x_si")) & physics.finite(F.col("y_si")) & F.col("property_id_y").isin(*K.ALLOWED_PROPERTIES))


def dedup_stream(points: DataFrame, keys: Sequence[str], event_time: str, delay: str = "30 days") -> DataFrame:
    """Exactly one row per key among rows at most ``delay`` apart in event time; state older than the watermark is dropped."""
    return points.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(points: DataFrame, event_time: str, width: str = "30 days", delay: str = "30 days") -> DataFrame:
    """Points and mean value per property and time window, late rows up to the watermark included."""
    return points.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w"), "property_id_y").agg(F.count(F.lit(1)).alias("n"), F.avg("y_si").alias("mean")).select(F.col("w.start").alias("start"), "property_id_y", "n", "mean")


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything there is now and stop; a later call with the same checkpoint resumes where this one ended."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
