"""Ingest jobs: deliveries to the audit tables, safe to run again."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.hashing import record_hash
from ledgerflow.layout import MERCHANT_COLUMNS, PAYMENT_COLUMNS
from ledgerflow.operators.contracts import check_columns
from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.dedup import drop_stored, new_rows
from ledgerflow.operators.joins import broadcast_if_small
from ledgerflow.operators.enrich import new_run_id, run_clock
from ledgerflow.operators.quality import ACCEPTED, BAD_AMOUNT, BAD_TIMESTAMP, OUT_OF_RANGE, row_fate
from ledgerflow.operators.typing import type_merchants, type_payments
from ledgerflow.plans.audit import (
    EMPTY,
    FAILED,
    INGESTED,
    MISSING_COLUMNS,
    OVERFLOWING,
    SUCCESS,
    delivery_measures,
    run_manifest,
    run_status,
    track_stage,
)
from ledgerflow.session import apply_job_settings, path_exists, sized_shuffles, small_splits, stage, staging_of_run
from ledgerflow.sources.columns import log_columns
from ledgerflow.sources.deliveries import HEADER_ID, TOO_LONG, Deliveries, Landing, read_landing
from ledgerflow.sources.indexes import index_rows, stored_hashes
from ledgerflow.sources.ledger import state_path
from ledgerflow.sources.tables import append_flat, append_partitioned, read_hashes, read_table

COUNT_COLUMNS = ["rows_read", "rows_written", "rows_skipped", "rows_quarantined", "rows_undated", "rows_out_of_range"]


@dataclass(frozen=True)
class IngestResult:
    """Status of a run and its counts, one row per delivery."""

    run_id: str
    status: str
    counts: DataFrame | None = None


# Helpers of a typed batch; deliveries may not use these names (see RESERVED).
FATE = "_ledgerflow_fate"
REJECTED_TEXT = "_ledgerflow_text"
# What became of the rows of a batch.
SHAPE_DDL = "source_file string, event_date string, fate string, overflow boolean, rows bigint"
# Columns the quarantine table adds to the payload.
QUARANTINE_COLUMNS = ("reason", "rejected_text")


def checked_files(landed: Deliveries, required: Sequence[str], files: DataFrame | None = None) -> DataFrame:
    """The files of a run with `missing` and `extra`: the columns their headers lack or add, comma-separated."""
    files = landed.files if files is None else files
    spark = landed.files.sparkSession
    checks = [check_columns(h, required) for h in landed.headers]
    table = spark.createDataFrame(
        [(i, ",".join(c.missing), ",".join(c.unexpected)) for i, c in enumerate(checks)],
        "header int, missing string, extra string",
    )
    return files.join(F.broadcast(table), "header", "left")


def gate_report(landed: Deliveries, required: Sequence[str]) -> DataFrame:
    """(source_file, passed, missing_columns, extra_columns, rows) of every delivery with a header."""
    return (
        checked_files(landed, required, landed.shapes())
        .filter("header IS NOT NULL")
        .groupBy("source_file", F.col("missing").alias("missing_columns"), F.col("extra").alias("extra_columns"))
        .agg(F.sum("rows").alias("rows"))
        .withColumn("passed", F.col("missing_columns") == "")
    )


def typed_batch(
    landed: Deliveries,
    files: DataFrame,
    run_id: str,
    ingest_ts: datetime,
    dates: DateRange | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Rows of these files with types, lineage, fate, TOO_LONG, and the text that failed to parse.

    The hash is taken over the columns of a file's own header: a column that
    only a later delivery brings must not change the hash of earlier rows.
    `exclude` names further columns the hash does not cover.
    """
    headers = [r[0] for r in files.filter("header IS NOT NULL").select("header").distinct().orderBy("header").collect()]
    raw = landed.rows(files, headers)
    payload = landed.columns(headers)
    # Deliveries without these columns are left out later, but their rows are counted here.
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in PAYMENT_COLUMNS if c not in payload})
    typed = type_payments(raw.withColumns({"_amount_text": F.col("amount"), "_time_text": F.col("transaction_ts")}))
    hashed = F.lit(None).cast("string")
    for h in headers:
        covered = (set(landed.headers[h]) & set(payload) | {"event_date"}) - set(exclude)
        hashed = F.when(F.col(HEADER_ID) == h, record_hash(typed, covered)).otherwise(hashed)
    fate = row_fate(dates)
    return (
        typed.withColumns(
            {
                "record_hash": hashed,
                "ingest_ts": F.lit(ingest_ts),
                "ingest_run_id": F.lit(run_id),
                FATE: fate,
            }
        )
        .withColumn(
            REJECTED_TEXT,
            F.when(F.col(FATE) == BAD_AMOUNT, F.col("_amount_text")).when(F.col(FATE) == BAD_TIMESTAMP, F.col("_time_text")),
        )
        .drop("_amount_text", "_time_text", HEADER_ID)
    )


def added_rows(
    spark: SparkSession, bronze_path: str, run_id: str, ingest_ts: datetime, dates: Sequence[str]
) -> DataFrame:
    """Source, hash, id and date of the rows this run added, read from the stored table itself."""
    table = read_table(
        spark,
        bronze_path,
        "ingest_run_id string, ingest_ts timestamp, source_file string, record_hash string, transaction_id string, event_date string",
    )
    own = (F.col("ingest_run_id") == run_id) & (F.col("ingest_ts") == F.lit(ingest_ts))
    return table.filter(F.col("event_date").isin(list(dates))).filter(own)


def delivery_counts(deliveries: DataFrame, fates: DataFrame, written: DataFrame) -> DataFrame:
    """One row per delivery: read = written + skipped + quarantined + undated + out of range.

    `deliveries` holds (source_file, outcome, missing_columns, rows_read),
    `fates` counts (source_file, fate, rows) of the rows that were looked at. A
    delivery that was left out skipped all its rows.
    """
    ingested = F.col("outcome") == INGESTED
    kinds = {"rows_quarantined": BAD_AMOUNT, "rows_undated": BAD_TIMESTAMP, "rows_out_of_range": OUT_OF_RANGE}
    sorted_out = fates.groupBy("source_file").agg(
        *[F.sum(F.when(F.col("fate") == f, F.col("rows")).otherwise(0)).alias(c) for c, f in kinds.items()]
    )
    return (
        deliveries.join(sorted_out, "source_file", "left")
        .join(written, "source_file", "left")
        .fillna(0, ["rows_read", "rows_written", *kinds])
        .withColumns({c: F.when(ingested, F.col(c)).otherwise(F.lit(0)) for c in kinds})
        .withColumn("rows_skipped", F.col("rows_read") - F.col("rows_written") - sum(F.col(c) for c in kinds))
        .select("source_file", "outcome", "missing_columns", *COUNT_COLUMNS)
    )


def delivery_outcomes(files: DataFrame, shapes: DataFrame) -> DataFrame:
    """(source_file, outcome, missing_columns, rows_read) of every listed delivery.

    `files` are checked files, `shapes` counts (source_file, overflow, rows) of their rows.
    """
    outcome = (
        F.when(F.col("missing_columns") != "", F.lit(MISSING_COLUMNS))
        .when(F.col("overflow"), F.lit(OVERFLOWING))
        .when(F.col("filled") > 0, F.lit(INGESTED))
        .otherwise(F.lit(EMPTY))
    )
    read = shapes.groupBy("source_file").agg(F.max("overflow").alias("overflow"), F.sum("rows").alias("rows_read"))
    return (
        files.groupBy("source_file")
        .agg(F.coalesce(F.max("missing"), F.lit("")).alias("missing_columns"), F.count("header").alias("filled"))
        .join(read, "source_file", "left")
        .fillna(0, ["rows_read"])
        .fillna(False, ["overflow"])
        .select("source_file", outcome.alias("outcome"), "missing_columns", "rows_read")
    )


def ingest_payments(
    spark: SparkSession,
    landing: Landing,
    bronze_path: str,
    *,
    run_id: str | None = None,
    dates: DateRange | None = None,
    columns: Sequence[str] | None = None,
    required: Sequence[str] = PAYMENT_COLUMNS,
    quarantine_path: str | None = None,
    manifest_path: str | None = None,
    report_path: str | None = None,
    ingest_ts: datetime | None = None,
    strict_unique: bool = False,
    hash_exclude: Iterable[str] = (),
    extra: Mapping[str, str] | None = None,
) -> IngestResult:
    """Append the new payments of all deliveries in `landing` to the audit table.

    All deliveries form one distributed batch whose result equals loading them
    one by one in name order. The landing folder is listed once and its rows are
    parsed once; the typed batch is staged, since ownership, append and counts
    all read it.
    Everything staged is deleted when the run ends.

    `dates` limits the run to a backfill range; rows are still only appended.
    `columns` promises one header for all deliveries; another one is an error.
    `hash_exclude` names columns the record hash does not cover.
    `extra` is recorded with the run in its manifest rows.
    Python collections here hold one short entry per header layout or per day.
    """
    apply_job_settings(spark)
    run_id, ingest_ts = run_id or new_run_id(), ingest_ts or run_clock()
    with (
        staging_of_run(spark),
        track_stage(spark, run_id, "bronze", report_path) as report,
        sized_shuffles(spark, landing.folder, landing.options()),
        # Many tasks of equal size keep all cores busy to the end of a stage.
        small_splits(spark),
    ):
        landed = read_landing(spark, landing, columns)
        files = checked_files(landed, required)
        shape = spark.createDataFrame([], SHAPE_DDL)
        batch = None
        if landed.headers:
            batch = stage(typed_batch(landed, files, run_id, ingest_ts, dates, hash_exclude), "payments-batch")
            # One pass answers which dates the batch has and what became of its rows.
            shape = stage(
                batch.groupBy("source_file", "event_date", F.col(FATE).alias("fate"), F.col(TOO_LONG).alias("overflow")).agg(
                    F.count(F.lit(1)).alias("rows")
                ),
                "batch-shape",
            )
        outcomes = stage(delivery_outcomes(files, shape), "outcomes")
        taken = outcomes.filter(F.col("outcome") == INGESTED).select("source_file")
        fates = shape.join(taken, "source_file", "left_semi").select("source_file", "fate", "rows", "event_date")
        written = spark.createDataFrame([], "source_file string, rows_written bigint")
        good = [r[0] for r in files.join(taken, "source_file", "left_semi").select("header").distinct().collect()]
        good = sorted(h for h in good if h is not None)
        if batch is not None and good:
            left_out = outcomes.filter((F.col("outcome") != INGESTED) & (F.col("rows_read") > 0)).select("source_file")
            if not left_out.isEmpty():
                batch = batch.join(broadcast_if_small(left_out), "source_file", "left_anti")
            # Columns that only deliveries without a place in the table have.
            batch = batch.drop(TOO_LONG, *sorted(set(landed.columns()) - set(landed.columns(good)) - set(PAYMENT_COLUMNS)))
            batch_dates = [
                r[0] for r in fates.filter(F.col("fate") == ACCEPTED).select("event_date").distinct().collect()
            ]
            candidates = batch.filter(F.col(FATE) == ACCEPTED).drop(FATE, REJECTED_TEXT)
            stored = stored_hashes(spark, bronze_path, batch_dates)
            # A folder that others filled has no ledger; its hashes and ids are read from itself.
            indexed = not path_exists(spark, bronze_path) or path_exists(spark, state_path(bronze_path, "files"))
            appended = Observation("appended")
            append_partitioned(new_rows(candidates, stored, strict_unique), bronze_path, written=appended)
            if quarantine_path:
                append_quarantine(batch, quarantine_path)
            if appended.get["rows"]:
                added = added_rows(spark, bronze_path, run_id, ingest_ts, batch_dates)
                if indexed:
                    kept = [f for f in candidates.schema.fields if f.name != "event_date"]
                    log_columns(spark, bronze_path, [*kept, candidates.schema["event_date"]], run_id)
                    index_rows(spark, bronze_path, added, run_id)
                written = added.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_written"))
        counts = stage(delivery_counts(outcomes, fates.drop("event_date"), written), "delivery-counts", keep=True)
        status = run_status(counts)
        report.record(delivery_measures(counts))
        if manifest_path:
            run_manifest(counts, run_id, ingest_ts, status, extra).write.mode("append").json(manifest_path)
        if counts.isEmpty():
            return IngestResult(run_id, status)
    return IngestResult(run_id, status, counts)


def append_quarantine(batch: DataFrame, path: str) -> None:
    """Store the rows set aside with reason and rejected text, each once however often its delivery is loaded."""
    clash = set(QUARANTINE_COLUMNS) & set(batch.columns)
    if clash:
        raise ValueError(f"the quarantine table needs these column names for itself: {sorted(clash)}")
    rows = batch.filter(F.col(FATE).isin(BAD_AMOUNT, BAD_TIMESTAMP)).withColumnsRenamed(
        {FATE: "reason", REJECTED_TEXT: "rejected_text"}
    )
    # The hash covers the typed row, which a text that fails to parse is no part of.
    text = F.concat_ws("|", "record_hash", "reason", "rejected_text")
    plain = rows.withColumns({"_plain_hash": F.col("record_hash"), "record_hash": F.sha2(text, 256)})
    stored = read_table(batch.sparkSession, path, "record_hash string, reason string, rejected_text string")
    fresh = new_rows(plain, stored.select(F.sha2(text, 256).alias("record_hash")))
    append_flat(stage(fresh.withColumn("record_hash", F.col("_plain_hash")).drop("_plain_hash"), "quarantine-new"), path)


def ingest_merchants(
    spark: SparkSession,
    csv_path: str,
    bronze_path: str,
    *,
    run_id: str | None = None,
    required: Sequence[str] = MERCHANT_COLUMNS,
    manifest_path: str | None = None,
    report_path: str | None = None,
    ingest_ts: datetime | None = None,
    hash_exclude: Iterable[str] = (),
    extra: Mapping[str, str] | None = None,
) -> IngestResult:
    """Append new or changed merchants to their unpartitioned version table."""
    apply_job_settings(spark)
    run_id, ingest_ts = run_id or new_run_id(), ingest_ts or run_clock()
    landing = Landing(csv_path, pattern="*")
    with staging_of_run(spark), track_stage(spark, run_id, "bronze_merchants", report_path) as report:
        landed = read_landing(spark, landing)
        files = checked_files(landed, required)
        complete = files.filter("missing <> ''").isEmpty()
        # A version table takes every listed row; a row beyond its header does not disqualify the file.
        if landed.headers and complete:
            batch = stage(merchant_batch(landed, run_id, ingest_ts, hash_exclude), "merchant-batch")
            shape = batch.groupBy("source_file").agg(F.lit(False).alias("overflow"), F.count(F.lit(1)).alias("rows"))
        else:
            shape = landed.shapes().select("source_file", "overflow", "rows")
        outcomes = stage(delivery_outcomes(files, shape), "outcomes")
        refused = outcomes.filter(F.col("outcome") == MISSING_COLUMNS)
        if not landed.headers:
            report.failed = True
            return IngestResult(run_id, FAILED)
        if not refused.isEmpty():
            # What is reported outlives the run's staged tables.
            report.record(
                stage(
                    refused.select(
                        F.col("source_file").alias("table_name"),
                        "rows_read",
                        F.lit(0).cast("bigint").alias("rows_written"),
                        F.col("rows_read").alias("rows_quarantined"),
                    ),
                    "refused",
                    keep=True,
                )
            )
            return IngestResult(run_id, FAILED)
        fresh = stage(drop_stored(batch, read_hashes(spark, bronze_path)), "merchant-new")
        append_flat(fresh, bronze_path)
        written = fresh.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_written"))
        fates = spark.createDataFrame([], "source_file string, fate string, rows bigint")
        counts = stage(delivery_counts(outcomes, fates, written), "delivery-counts", keep=True)
        report.record(delivery_measures(counts))
        if manifest_path:
            run_manifest(counts, run_id, ingest_ts, SUCCESS, extra).write.mode("append").json(manifest_path)
    return IngestResult(run_id, SUCCESS, counts)


def merchant_batch(landed: Deliveries, run_id: str, ingest_ts: datetime, exclude: Iterable[str] = ()) -> DataFrame:
    """Merchant rows with types, hash and lineage; the hash covers the columns of a file's own header."""
    typed = type_merchants(landed.rows())
    payload = set(landed.columns())
    hashed = F.lit(None).cast("string")
    for h, header in enumerate(landed.headers):
        hashed = F.when(F.col(HEADER_ID) == h, record_hash(typed, set(header) & payload - set(exclude))).otherwise(hashed)
    return typed.withColumns(
        {"record_hash": hashed, "ingest_ts": F.lit(ingest_ts), "ingest_run_id": F.lit(run_id)}
    ).drop(HEADER_ID, TOO_LONG)
