"""Spark session defaults and the shared folder for staged tables."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every job relies on.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles a longer method; typing and hashing a row would fill one that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_local_folder: str | None = None


def build_session(app: str = "ledgerflow", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the job settings; extra settings use `__` for dots in their names."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in JOB_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_job_settings(spark: SparkSession) -> SparkSession:
    """Set the job settings on a session somebody else created."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Input bytes per shuffle partition before AQE merges small ones.
SHUFFLE_INPUT_BYTES = 256 * 1024 * 1024
# The same for a stored Parquet table, which is several times smaller than its rows are in a shuffle.
PARQUET_INPUT_BYTES = 8 * 1024 * 1024
# What a task reads of a table: its rows are sorted or hashed there before the shuffle, some twenty times as large.
SPLIT_BYTES = 16 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(
    spark: SparkSession, path: str, options: dict[str, str], partition_bytes: int = SHUFFLE_INPUT_BYTES
) -> Iterator[int]:
    """Within the block, start shuffles with partitions that fit the input at `path`.

    AQE merges partitions that turn out small but cannot add any, and the usual
    200 would be hundreds of gigabytes each on a large input. Lists file sizes
    only. The caller's setting is restored; yields the number in force. A driver
    that should track fewer partitions passes more `partition_bytes`.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    total = 0
    if path_exists(spark, path):
        files = spark.read.format("binaryFile").options(**options).load(path)
        total = files.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / partition_bytes))
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


@contextmanager
def small_splits(spark: SparkSession, split_bytes: int = SPLIT_BYTES) -> Iterator[None]:
    """Scans planned within the block give a task no more than `split_bytes` of a file."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(split_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or a match of a glob is there, in any Hadoop file system.

    Asked beforehand, because a read that fails on a missing path leaves a stack
    trace in the log of every later query listener.
    """
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location)
    return found is not None and len(found) > 0


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path part of a location, absolute in its file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location).toUri().getPath()


def delete_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in spark.checkpoint.dir.

    Only a session whose executors are threads of the driver (`local[...]`) gets
    a temporary folder without that setting; elsewhere a missing setting is an
    error, since a machine-local folder would lose staged data together with its
    machine. For the same reason a cluster may not name a `file:` path.
    """
    global _local_folder
    master = spark.sparkContext.master
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if configured.startswith("file:") and not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir must be shared by all executors, got {configured}")
        return configured.rstrip("/")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="ledgerflow-")
    return _local_folder


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/ledgerflow/{label}-{uuid4().hex}"


# Paths staged by the runs that are under way, innermost last.
_runs: list[list[str]] = []


@contextmanager
def staging_of_run(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged within the block when it ends, also on failure; `stage(keep=True)` stays."""
    paths: list[str] = []
    _runs.append(paths)
    try:
        yield
    finally:
        _runs.remove(paths)
        for path in paths:
            delete_path(spark, path)


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage at a point where several consumers would otherwise repeat
    the work below, and survives the loss of any executor. Within a run the copy
    goes when the run ends, unless a frame that is handed out reads it (`keep`).
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    if _runs and not keep:
        _runs[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
