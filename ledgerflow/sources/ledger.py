"""The files of a stored table: what was written, and whether it is still there.

A table has a ledger beside it, `<table>_state/files`, with one row per file: its path below the table, its bytes, its rows,
and the sum of a hash over their record hashes. A run adds its files when everything else it stores is in place, so the
ledger also says which files the indexes beside the table cover. Comparing a listing with the ledger opens no file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import path_exists, qualified_path, stage
from ledgerflow.sources.tables import read_table

LEDGER_DDL = "path string, bytes bigint, rows bigint, checksum decimal(38,0), run_id string"


def state_path(table: str, name: str) -> str:
    """Where something kept beside a table lies."""
    return f"{table.rstrip('/')}_state/{name}"


def relative(spark: SparkSession, table: str, path: Column) -> Column:
    """The part of a file's location below the table folder; URIs may be encoded or not."""
    base = qualified_path(spark, table).rstrip("/") + "/"
    text = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.substring_index(text, base, -1)


def day_of(path: Column) -> Column:
    """The event date in a path, NULL outside partitions."""
    day = F.regexp_extract(path, "event_date=([^/]*)/", 1)
    return F.when(day != "", day)


def listed_files(spark: SparkSession, table: str) -> DataFrame:
    """(path, bytes) of the table's files as they are now; no file is opened."""
    if not path_exists(spark, table):
        return spark.createDataFrame([], "path string, bytes bigint")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(table)
    return found.select(relative(spark, table, F.col("path")).alias("path"), F.col("length").alias("bytes"))


def recorded_files(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, state_path(table, "files"), LEDGER_DDL)


def checksum() -> Column:
    """Does not depend on the order of rows; a decimal, so no sum wraps around."""
    return F.coalesce(F.sum(F.xxhash64("record_hash").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def file_shapes(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """(path, rows, checksum) per file of `rows`, which come from a scan of the table and keep its hidden metadata."""
    path = relative(spark, table, F.col("_metadata.file_path"))
    return rows.select(path.alias("path"), "record_hash").groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), checksum().alias("checksum")
    )


def record_files(spark: SparkSession, table: str, shapes: DataFrame, run_id: str) -> None:
    """Add files with their rows and checksums to the ledger, each with the bytes it has now."""
    files = shapes.join(listed_files(spark, table), "path").withColumn("run_id", F.lit(run_id))
    files.select("path", "bytes", "rows", "checksum", "run_id").write.mode("append").parquet(state_path(table, "files"))


def differing_files(spark: SparkSession, table: str) -> DataFrame:
    """(path, day, found): files the ledger does not have as they are (`new`), or that it has otherwise (`changed`, `gone`).

    A file is gone only where its folder still has files: whole partitions may be dropped on purpose.
    """
    listed, recorded = listed_files(spark, table), recorded_files(spark, table).select("path", F.col("bytes").alias("recorded"))
    both = listed.join(recorded.dropDuplicates(["path"]), "path", "full")
    found = (
        F.when(F.col("recorded").isNull(), "new").when(F.col("bytes").isNull(), "gone").when(F.col("bytes") != F.col("recorded"), "changed")
    )
    odd = both.select("path", day_of(F.col("path")).alias("day"), found.alias("found")).filter("found IS NOT NULL")
    folder = F.regexp_replace("path", "[^/]*$", "")
    present = listed.select(folder.alias("folder")).distinct()
    return odd.withColumn("folder", folder).join(present, "folder", "left_semi").select("path", "day", "found")


def untrusted_days(spark: SparkSession, table: str) -> list[str | None]:
    """Days whose files are not exactly those of the ledger: what is kept beside the table may not cover them.

    Partitions that were dropped as a whole count as well. The driver receives days, not files.
    """
    listed, recorded = listed_files(spark, table), recorded_files(spark, table).select("path", F.col("bytes").alias("recorded"))
    both = listed.join(recorded.dropDuplicates(["path"]), "path", "full")
    odd = both.filter(~F.col("bytes").eqNullSafe(F.col("recorded")))
    return sorted((r[0] for r in odd.select(day_of(F.col("path")).alias("day")).distinct().collect()), key=str)


def _with_folder(paths: DataFrame) -> DataFrame:
    return paths.select("path", F.element_at(F.split("path", "/"), -2).alias("folder"))


def damaged_by_listing(spark: SparkSession, table: str) -> DataFrame:
    """(path, partition folder) of recorded files that are gone or have another length; no file is opened."""
    return _with_folder(differing_files(spark, table).filter("found IN ('gone', 'changed')"))


def expected_shape(spark: SparkSession, table: str) -> tuple[int, int] | None:
    """(rows, checksum) that a scan of the files that are as recorded must see, None if there are files without a record."""
    odd = stage(differing_files(spark, table).select("path", "found"), "differing-files")
    if not odd.filter("found = 'new'").isEmpty():
        return None
    sound = recorded_files(spark, table).join(listed_files(spark, table).select("path"), "path", "left_semi")
    sound = sound.dropDuplicates(["path"]).join(odd, "path", "left_anti")
    rows, total = sound.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("checksum"), F.lit(0))).first()
    return int(rows), int(total)


def damaged_by_content(spark: SparkSession, table: str) -> DataFrame:
    """(path, partition folder) of files whose rows are not those recorded, or that cannot be read to their end.

    Reads one column of the table once; files without a record are held against the row counts of their footers.
    """
    listed = listed_files(spark, table).select("path")
    lenient = spark.read.schema("record_hash string, event_date string").option("ignoreCorruptFiles", True).parquet(table)
    seen = file_shapes(spark, table, lenient)
    path = relative(spark, table, F.col("_metadata.file_path"))
    promised = lenient.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("promised"))
    recorded = recorded_files(spark, table).dropDuplicates(["path"])
    recorded = recorded.select("path", F.col("rows").alias("n"), F.col("checksum").alias("total"))
    every = listed.join(seen, "path", "left").join(recorded, "path", "left").join(promised, "path", "left")
    wanted = F.coalesce("n", "promised")
    broken = wanted.isNull() | (F.coalesce("rows", F.lit(0)) != wanted) | (F.col("checksum") != F.col("total"))
    return _with_folder(every.filter(broken))
