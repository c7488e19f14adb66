"""Session helpers: reading tables, the shared folder, and written intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []
_TABLES: list[tuple[SparkSession, str]] = []
_LOCAL_FOLDERS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables: a Parquet file or a folder of Parquet files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (a test) gets a temporary folder of its own;
    a cluster without it is an error, because a machine-local folder is not visible to other executors.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = "file://" + tempfile.mkdtemp(prefix="kelvinlake-")
    return _LOCAL_FOLDERS[app]


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as a Hadoop object."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def swap_folders(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of ``path``; what was there is kept until then, and put back if the move fails."""
    fs, new = filesystem(spark, staged)
    _, target = filesystem(spark, path)
    _, backup = filesystem(spark, f"{path}.old")
    fs.delete(backup, True)
    if fs.exists(target) and not fs.rename(target, backup):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(new, target):
        if fs.exists(backup):
            fs.rename(backup, target)
        raise OSError(f"{staged} could not be moved to {path}")
    fs.delete(backup, True)


def absolute_uri(path: str) -> str:
    """A path as executors' own file access takes it: Hadoop's ``file:/x`` and a bare ``/x`` become ``file:///x``."""
    if path.startswith("/"):
        return f"file://{path}"
    return "file:///" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed by :func:`release` or at exit."""
    path = f"{shared_dir(spark)}/kelvinlake/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append((spark, path))
    return path


def written(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a DataFrame once into the shared folder and read it back.

    It cuts the lineage and survives the loss of any executor, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, keys: list[str], partition_by: str) -> DataFrame:
    """Write a DataFrame once into the shared folder, partitioned by a column and bucketed by keys, and read it back.

    Joins and aggregations on exactly these keys need no shuffle. Each task writes one bucket of each partition.
    """
    spark = df.sparkSession
    n, path = shuffle_partitions(spark), scratch_path(spark, tag)
    name = f"kelvinlake_{uuid.uuid4().hex}"
    writer = df.repartition(n, *keys).write.format("parquet").option("path", path).option("compression", "zstd").partitionBy(partition_by)
    writer.bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    _TABLES.append((spark, name))
    return spark.table(name)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table this session has written."""
    global _WRITTEN, _TABLES
    for name in [n for s, n in _TABLES if s is spark]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _TABLES = [(s, n) for s, n in _TABLES if s is not spark]
    mine = [p for s, p in _WRITTEN if s is spark]
    _WRITTEN = [(s, p) for s, p in _WRITTEN if s is not spark]
    for path in mine:
        fs, hadoop_path = filesystem(spark, path)
        fs.delete(hadoop_path, True)


@atexit.register
def _release_all() -> None:
    for spark, _ in list(_WRITTEN):
        try:
            if spark.sparkContext._jsc is not None:
                release(spark)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit
            return


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, tasks_per_core: int = 3) -> DataFrame:
    """Deal rows to more tasks where a scan gives too few for work that is heavy per row (tokenizing, decoding).

    Input of few or very unequal splits would leave cores idle; rows are moved once, whole, and in any order.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(tasks_per_core * cores)
