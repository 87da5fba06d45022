"""Stored tables: typed reads with partition pruning, ad-hoc views, and writes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.layout import BRONZE_MERCHANTS_DDL, BRONZE_PAYMENTS_DDL
from ledgerflow.operators.dates import DateRange
from ledgerflow.session import path_exists


def read_table(
    spark: SparkSession,
    path: str,
    ddl: str,
    columns: Sequence[str] | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """A Parquet table with its declared types; no rows if the path does not exist.

    A declared schema spares the footer reads of inference, keeps dates in
    directory names as text, and gives NULL for columns older files lack.
    """
    if path_exists(spark, path):
        table = spark.read.schema(ddl).option("ignoreCorruptFiles", skip_corrupt).parquet(path)
    else:
        table = spark.createDataFrame([], ddl)
    return table.select(*columns) if columns else table


def read_bronze(
    spark: SparkSession,
    path: str,
    dates: DateRange | Iterable[str] | None = None,
    columns: Sequence[str] | None = None,
    extra_columns: Sequence[str] = (),
    skip_corrupt: bool = False,
) -> DataFrame:
    """The payments audit table, or the partitions of some dates. A damaged file fails the read.

    `extra_columns` names columns of evolved deliveries to read as well.
    """
    ddl = BRONZE_PAYMENTS_DDL + "".join(f", `{c}` string" for c in extra_columns)
    table = read_table(spark, path, ddl, skip_corrupt=skip_corrupt)
    if isinstance(dates, DateRange):
        table = table.filter(dates.holds(F.col("event_date")))
    elif dates is not None:
        table = table.filter(F.col("event_date").isin(list(dates)))
    return table.select(*columns) if columns else table


def read_hashes(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Stored record hashes, only of the given partitions.

    A damaged file fails the read: skipping its hashes would admit duplicates.
    """
    if dates is None:
        return read_table(spark, path, "record_hash string")
    table = read_table(spark, path, "record_hash string, event_date string")
    return table.filter(F.col("event_date").isin(list(dates))).select("record_hash")


def read_bronze_merchants(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BRONZE_MERCHANTS_DDL)


def read_merchant_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The merchant CSV that reports join; ids stay text, a missing file gives no rows."""
    ddl = (
        "merchant_id string, merchant_name string, merchant_category string, country string, "
        "onboarding_date string, is_active string, settlement_currency string"
    )
    if not path_exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("header", True).option("escape", '"').csv(path)


def damaged_files(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """(path, partition folder) of the files of a table that cannot be read to their end.

    Compares what footers promise with what can be read, per file; reads the table once.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("path"))
    lenient = spark.read.schema(ddl).option("ignoreCorruptFiles", True).parquet(path)
    promised = lenient.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("promised"))
    values = F.xxhash64(*[c for c in lenient.columns])
    readable = lenient.select(F.col("_metadata.file_path").alias("path"), values.alias("h")).groupBy("path").agg(
        F.count("h").alias("readable")
    )
    both = listed.join(promised, "path", "left").join(readable, "path", "left")
    broken = F.col("promised").isNull() | (F.coalesce("readable", F.lit(0)) != F.col("promised"))
    return both.filter(broken).select("path", F.element_at(F.split("path", "/"), -2).alias("folder"))


def by_partition(df: DataFrame, partition: str) -> DataFrame:
    """Bring each partition value together, in as many tasks as its size needs.

    AQE splits a date that holds most of the rows and merges small dates, so a
    write leaves few, evenly sized files and no task writes a whole day alone.
    """
    return df.hint("rebalance", partition)


def counted(df: DataFrame, written: Observation | None) -> DataFrame:
    return df if written is None else df.observe(written, F.count(F.lit(1)).alias("rows"))


def append_partitioned(
    df: DataFrame, path: str, partition: str = "event_date", written: Observation | None = None
) -> None:
    """Add files below the partitions of `df`; the caller filters NULL dates. `written` counts the rows."""
    counted(by_partition(df, partition), written).write.mode("append").partitionBy(partition).parquet(path)


def append_flat(df: DataFrame, path: str) -> None:
    """Add rows to an unpartitioned table; nothing is written for no rows."""
    if not df.isEmpty():
        df.write.mode("append").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str, written: Observation | None = None) -> None:
    """Replace exactly the partitions present in `df` and leave the others; `written` counts the rows.

    The option matters: in Spark's default mode the whole table would be replaced.
    """
    (
        counted(by_partition(df, partition), written)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
