"""The columns of an evolving table, logged when a run adds them, so that no reader has to open every file's footer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.session import path_exists
from ledgerflow.sources.ledger import recorded_files, state_path, untrusted_days

PARTITIONS = ("event_date", "snapshot_date")
LOG_DDL = "place int, name string, type string, run_id string"


def logged_columns(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """(name, type) of the table's columns in the order they came; nothing without a log."""
    path = state_path(table, "columns")
    if not path_exists(spark, path):
        return []
    log = spark.read.schema(LOG_DDL).parquet(path)
    first = log.groupBy("name").agg(F.min(F.struct("place", "type")).alias("first"))
    rows = first.select("name", "first.place", "first.type").orderBy("place", "name").collect()
    return [(r["name"], r["type"]) for r in rows]


def log_columns(spark: SparkSession, table: str, columns: Sequence[T.StructField], run_id: str) -> None:
    """Add the columns that the log does not have yet. A column that has another type there is an error."""
    known = dict(logged_columns(spark, table))
    changed = [c.name for c in columns if known.get(c.name, c.dataType.simpleString()) != c.dataType.simpleString()]
    if changed:
        raise ValueError(f"columns change their type: {changed}")
    fresh = [c for c in columns if c.name not in known]
    if fresh:
        rows = [(len(known) + i, c.name, c.dataType.simpleString(), run_id) for i, c in enumerate(fresh)]
        spark.createDataFrame(rows, LOG_DDL).coalesce(1).write.mode("append").parquet(state_path(table, "columns"))


def logged_schema(spark: SparkSession, table: str) -> str | None:
    """The table's schema by its log, None if files were added without it."""
    columns = logged_columns(spark, table)
    if not columns or recorded_files(spark, table).isEmpty() or untrusted_days(spark, table):
        return None
    return ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in columns)


def read_evolved(spark: SparkSession, table: str, partition: str = "event_date") -> DataFrame:
    """A table with the union of the columns of all its files: by the log, or without one from every footer."""
    schema = logged_schema(spark, table)
    if schema is not None:
        return spark.read.schema(schema).parquet(table)
    found = spark.read.option("mergeSchema", True).parquet(table)
    return found.withColumn(partition, F.col(partition).cast("string")) if partition in found.columns else found


def register_views(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Make stored tables available to `spark.sql`, with the columns of evolved files; dates in directory names stay text."""
    for name, path in paths.items():
        table = read_evolved(spark, path)
        dates = {c: F.col(c).cast("string") for c in PARTITIONS if c in table.columns}
        table.withColumns(dates).createOrReplaceTempView(name)
