"""The newest version of every transaction as a stored table, merged forward with what was ingested since.

The table lies beside the audit table, by day and without personal data, together with the list of audit files it covers;
one pointer publishes both. A refresh reads the files that are not covered yet, finds the days that hold the current versions
of their transactions (by the index), and merges and rewrites only those days. A covered file that changed or went makes
the refresh a full rebuild.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.dedup import VERSION_TIE_BREAKERS, as_bytes, latest_per_transaction
from ledgerflow.operators.joins import broadcast_if_small
from ledgerflow.plans.reports import REPORT_INPUT
from ledgerflow.session import stage
from ledgerflow.sources.indexes import days_of, transaction_days
from ledgerflow.sources.ledger import day_of, listed_files, relative, state_path
from ledgerflow.sources.tables import read_bronze
from ledgerflow.sources.versions import Publication, holds_any

CURRENT_DDL = (
    "transaction_id string, merchant_id string, currency string, status string, payment_method string, amount double, "
    "ingest_ts timestamp, transaction_ts timestamp, source_file string, record_hash binary, event_date string"
)
COVERED_DDL = "path string, bytes bigint"
CURRENT_COLUMNS = [c.split()[0] for c in CURRENT_DDL.split(", ")]


def publication(bronze_path: str) -> Publication:
    tables = {name: state_path(bronze_path, name) for name in ("current", "covered")}
    return Publication(state_path(bronze_path, "published"), tables)


@dataclass(frozen=True)
class Refreshed:
    """Days whose current payments may have changed, and whether all days were built anew."""

    days: list[str]
    rebuilt: bool


def versions(audit: DataFrame) -> DataFrame:
    """Audit rows with the columns of the state."""
    return audit.withColumn("record_hash", as_bytes()).select(*CURRENT_COLUMNS)


def newest(rows: DataFrame) -> DataFrame:
    return latest_per_transaction(rows, CURRENT_COLUMNS, VERSION_TIE_BREAKERS)


def current_state(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The stored current payments, as the reports take them."""
    stored = publication(bronze_path).read(spark, "current", CURRENT_DDL, "event_date")
    return stored.select(*REPORT_INPUT)


def refresh_current(spark: SparkSession, bronze_path: str, run_id: str) -> Refreshed:
    """Bring the stored current payments up to the audit table; equal to building them anew."""
    published = publication(bronze_path)
    listed = stage(listed_files(spark, bronze_path), "listed-files")
    covered = published.read(spark, "covered", COVERED_DDL)
    both = listed.select("path", "bytes", F.lit(True).alias("there")).join(
        covered.select("path", F.col("bytes").alias("known")), "path", "full"
    )
    kind = F.when(F.col("there").isNull() | (F.col("known") != F.col("bytes")), "lost").when(F.col("known").isNull(), "fresh")
    odd = stage(both.select("path", kind.alias("kind")).filter("kind IS NOT NULL"), "odd-files")
    kinds = {r["kind"] for r in odd.select("kind").distinct().collect()}
    before = published.state(spark).get("current", {})
    if not kinds:
        return Refreshed([], False)
    rebuilt = "lost" in kinds or not before
    if rebuilt:
        written = published.write(newest(versions(read_bronze(spark, bronze_path))), "current", run_id, "event_date")
        touched = sorted({*before, *written})
    else:
        fresh = odd.filter("kind = 'fresh'").select(F.col("path").alias("_fresh"))
        days = [r[0] for r in fresh.select(day_of(F.col("_fresh"))).distinct().collect()]
        rows = read_bronze(spark, bronze_path, days).withColumn("_path", relative(spark, bronze_path, F.col("_metadata.file_path")))
        own = rows.join(broadcast_if_small(fresh), F.col("_path") == F.col("_fresh"), "left_semi")
        batch = stage(versions(own), "fresh-versions")
        ids = stage(batch.select(F.xxhash64("transaction_id").alias("id_hash")).distinct(), "fresh-ids")
        index = transaction_days(spark, bronze_path)
        if index is None:
            index = published.read(spark, "current", CURRENT_DDL, "event_date").select(
                F.xxhash64("transaction_id").alias("id_hash"), "event_date"
            )
        touched = sorted({*days, *days_of(index, broadcast_if_small(ids))})
        old = published.read(spark, "current", CURRENT_DDL, "event_date").filter(holds_any("event_date", touched))
        written = published.write(newest(old.unionByName(batch)), "current", run_id, "event_date")
    files = published.write(listed, "covered", run_id)
    changes = {"current": dict.fromkeys(touched) | written, "covered": files}
    published.publish(spark, changes)
    return Refreshed(touched, rebuilt)
