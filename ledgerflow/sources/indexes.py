"""Indexes beside the audit table: stored hashes, and the days that hold a transaction.

Both are bucketed, so looking something up shuffles what is looked up and not the index. They are written after the rows
they cover and before the ledger of files. A day whose files are not exactly those of the ledger (a run that broke off,
files added or deleted by others) is read from the table itself, so an index can be late but never wrong.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.dedup import as_bytes
from ledgerflow.session import path_exists
from ledgerflow.sources.buckets import Bucketed
from ledgerflow.sources.ledger import file_shapes, record_files, state_path, untrusted_days
from ledgerflow.sources.tables import read_hashes, read_table

# So few keys are looked up by value, which opens their buckets alone.
FEW_KEYS = 64


def hash_index(table: str) -> Bucketed:
    """Hashes by month, one file per run and bucket; the days of a run's file are in its statistics."""
    return Bucketed(state_path(table, "hashes"), "hash binary, event_date string, month string", "hash", "month")


def id_index(table: str) -> Bucketed:
    """Days by the 64-bit hash of a transaction id; ids that share a hash share their days, which only reads more."""
    return Bucketed(state_path(table, "ids"), "id_hash bigint, event_date string", "id_hash")


def month_of(day: Column) -> Column:
    return F.substring(day, 1, 7)


def index_rows(spark: SparkSession, table: str, rows: DataFrame, run_id: str) -> None:
    """Cover `rows`, just appended to the table and scanned from it: indexes first, then the ledger."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashes = rows.select(as_bytes().alias("hash"), "event_date").distinct()
    hash_index(table).append(hashes.withColumn("month", month_of(F.col("event_date"))), buckets)
    id_index(table).append(rows.select(F.xxhash64("transaction_id").alias("id_hash"), "event_date").distinct(), buckets)
    record_files(spark, table, file_shapes(spark, table, rows), run_id)


def rebuild_indexes(spark: SparkSession, table: str, run_id: str = "rebuild") -> None:
    """Cover every row of a table that has no indexes yet. Fails if some are there: delete `<table>_state` first."""
    if path_exists(spark, state_path(table, "files")):
        raise ValueError(f"{table} has a ledger already")
    rows = spark.read.schema("record_hash string, transaction_id string, event_date string").parquet(table)
    index_rows(spark, table, rows, run_id)


def stored_hashes(spark: SparkSession, table: str, dates: Iterable[str]) -> DataFrame:
    """(hash) of the rows stored on these days, as bytes: from the index, and from the table where it does not cover a day."""
    wanted = set(dates)
    index = hash_index(table).read(spark)
    if index is None:
        return read_hashes(spark, table, wanted).select(as_bytes().alias("hash"))
    late = wanted.intersection(d for d in untrusted_days(spark, table) if d is not None)
    days = sorted(wanted - late)
    found = index.filter(F.col("month").isin(sorted({d[:7] for d in days})) & F.col("event_date").isin(days)).select("hash")
    return found.unionByName(read_hashes(spark, table, late).select(as_bytes().alias("hash"))) if late else found


def transaction_days(spark: SparkSession, table: str) -> DataFrame | None:
    """(id_hash, event_date) of all stored transactions, None if the table has no index."""
    index = id_index(table).read(spark)
    if index is None:
        return None
    late = [d for d in untrusted_days(spark, table) if d is not None]
    if not late:
        return index
    rows = read_table(spark, table, "transaction_id string, event_date string").filter(F.col("event_date").isin(late))
    own = rows.select(F.xxhash64("transaction_id").alias("id_hash"), "event_date")
    return index.filter(~F.col("event_date").isin(late)).unionByName(own)


def days_of(index: DataFrame, hashes: DataFrame, few: int = FEW_KEYS) -> list[str]:
    """Days that hold any of the transactions whose `id_hash` is in `hashes`; the driver receives days."""
    some = hashes.limit(few + 1).collect()
    if len(some) <= few:
        held = index.filter(F.col("id_hash").isin([r[0] for r in some]))
    else:
        held = index.join(hashes, "id_hash", "left_semi")
    return [r[0] for r in held.select("event_date").distinct().collect()]
