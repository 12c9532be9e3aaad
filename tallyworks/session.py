"""Session settings and the places where a job may touch disk or the driver."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may hold to be shipped whole to every executor. At some hundred bytes a row this
# is tens of megabytes; larger sides take the shuffle join, where AQE splits hot keys.
BROADCAST_ROWS = 200_000

_local_root: tempfile.TemporaryDirectory | None = None

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.maxMetadataStringLength": "1000",  # printed plans name whole paths
}


def build_session(app_name: str = "tallyworks", **overrides: str) -> SparkSession:
    """A session with the settings the jobs count on; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, so that timestamps mean the same on every cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` is counted to hold at most ``max_rows`` rows, else leave it alone.

    The count stops one row past the bound. Meant for look-up tables joined on very skewed keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread_if_few(df: DataFrame, few: int = 32) -> DataFrame:
    """Deal the rows of a small input out to all cores when its files make too few scan tasks.

    A file with one row group is one task however many cores there are. Inputs of ``few`` splits
    or more, which is every large one, are left as they are: no shuffle is added.
    """
    cores = min(df.sparkSession.sparkContext.defaultParallelism, few)
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a temp folder only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_root
    _local_root = tempfile.TemporaryDirectory(prefix="tallyworks-")  # goes when the process ends
    spark.conf.set("spark.checkpoint.dir", _local_root.name)
    return _local_root.name


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a shared table and read it back, so that several steps can use it.

    Unlike a cache this survives lost executors, and later narrow reads prune its columns.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/staged/{label}-{uuid.uuid4().hex}"
    written = _staged.get()
    if written is not None:
        written.append(path)
    return write_and_read(df, path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_tables_dropped(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends; for jobs whose results are stored by then."""
    written: list[str] = []
    token = _staged.set(written)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in written:
            remove_folder(spark, path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    folder, files = _folder(spark, path)
    return files.getContentSummary(folder).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system, if it is there."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name on the same file system."""
    folder, files = _folder(spark, path)
    if not files.rename(folder, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder; none if it is not there."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
