"""Every operator as a query over the driver tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.hashing import record_hash
from ledgerflow.functions.measures import exact_part, fine_part, inexact_part, money, round_to
from ledgerflow.functions.measures import reversal_rate as rate_of_reversals
from ledgerflow.layout import DAILY_SUMMARY_DDL, PAYMENT_COLUMNS, performance_ddl
from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.dedup import drop_stored, first_delivery_wins
from ledgerflow.operators.enrich import enrich
from ledgerflow.operators.joins import left_join_dimension
from ledgerflow.operators.quality import accepted, row_fate
from ledgerflow.operators.trailing import active_spine
from ledgerflow.operators.typing import type_merchants, type_payments
from ledgerflow.plans import reports
from ledgerflow.plans.audit import read_manifest, read_report
from ledgerflow.plans.bronze import gate_report, ingest_merchants, ingest_payments
from ledgerflow.plans.gold import build_reports, update_reports
from ledgerflow.plans.state import current_state, refresh_current
from ledgerflow.session import PARQUET_INPUT_BYTES, path_exists, sized_shuffles, small_splits, stage, staging_path
from ledgerflow.sources.deliveries import Landing, read_deliveries, read_landing
from ledgerflow.sources.columns import read_evolved, register_views
from ledgerflow.sources.tables import append_flat, overwrite_partitions, read_bronze, read_bronze_merchants, read_table
from ledgerflow.sources.versions import Publication
from workload import views

FIRST_RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)
LATER_RUN = datetime(2024, 2, 2, tzinfo=timezone.utc)
BACKFILL = DateRange("2024-01-10", "2024-01-16")
STORED_COLUMNS = ["transaction_id", "merchant_id", "amount", "currency", "status", "payment_method", "event_date"]
LINE_HASH_COLUMNS = [*STORED_COLUMNS, "part", "quantity", "return_flag", "line_status"]


# --- reports over lineitem ------------------------------------------------------


def line_totals(spark: SparkSession, folder: str) -> DataFrame:
    current = reports.current_payments(views.line_payments(spark, folder), views.LINE_TIE_BREAKERS)
    return reports.daily_totals(current)


def staged_line_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The totals, staged by tasks of a bounded size."""
    with small_splits(spark), sized_shuffles(spark, f"{folder}/lineitem.parquet", {}, PARQUET_INPUT_BYTES):
        return stage(line_totals(spark, folder), "line-totals")


def latest_status_per_txn(spark: SparkSession, folder: str) -> DataFrame:
    current = reports.current_payments(views.line_payments(spark, folder), views.LINE_TIE_BREAKERS)
    return current.withColumn("event_date", F.col("event_date").cast("string"))


def daily_payment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.daily_payment_summary(line_totals(spark, folder), views.line_merchants(spark, folder))


def merchant_performance(window_days: int):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        totals = staged_line_totals(spark, folder)
        return reports.merchant_performance(totals, views.line_merchants(spark, folder), reports.ReportRules(window_days))

    return query


def exact_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of amounts with many digits, by merchant."""
    lines = views.table(spark, folder, "lineitem")
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 7
    parts = lines.select(F.col("l_suppkey").cast("string").alias("merchant_id"), amount.cast("double").alias("amount"))
    sums = parts.groupBy("merchant_id").agg(
        F.sum(exact_part(F.col("amount"))).alias("exact"),
        F.sum(fine_part(F.col("amount"))).alias("fine"),
        F.sum(inexact_part(F.col("amount"))).alias("inexact"),
    )
    return sums.select("merchant_id", round_to(money(F.col("exact"), F.col("fine"), F.col("inexact")), 4).alias("total_amount"))


def approval_rate(spark: SparkSession, folder: str) -> DataFrame:
    rates = reports.daily_approval_rates(line_totals(spark, folder))
    return rates.withColumn("event_date", F.col("event_date").cast("string"))


def line_merchant_days(spark: SparkSession, folder: str) -> DataFrame:
    return reports.merchant_days(line_totals(spark, folder))


def reversal_rate(spark: SparkSession, folder: str) -> DataFrame:
    return line_merchant_days(spark, folder).select(
        F.date_from_unix_date("day").cast("string").alias("event_date"),
        "merchant_id",
        rate_of_reversals(F.col("reversals"), F.col("payments")).alias("reversal_rate"),
    )


def active_days(spark: SparkSession, folder: str) -> DataFrame:
    return line_merchant_days(spark, folder).groupBy("merchant_id").agg(F.count(F.lit(1)).alias("active_days"))


def date_merchant_spine(spark: SparkSession, folder: str) -> DataFrame:
    totals = staged_line_totals(spark, folder)
    days = reports.merchant_days(totals, tasks=reports.merchant_tasks(totals, 7))
    spine = active_spine(days, "merchant_id", reports.snapshot_days(totals), 7)
    names = reports.merchant_names(views.line_merchants(spark, folder))
    return spine.join(names, "merchant_id", "left").select(
        F.date_from_unix_date("snapshot_day").cast("string").alias("snapshot_date"), "merchant_id", "merchant_name"
    )


def left_join(spark: SparkSession, folder: str) -> DataFrame:
    payments = views.line_payments(spark, folder).select("transaction_id", "merchant_id", "amount", "event_date")
    return left_join_dimension(payments, views.line_merchants(spark, folder), "merchant_id")


def hashed_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = views.line_payments(spark, folder)
    return lines.withColumn("record_hash", record_hash(lines, LINE_HASH_COLUMNS))


def dedup_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = stage(hashed_lines(spark, folder), "hashed-lines")
    stored = lines.filter("event_date < '1998-07-01'")
    return drop_stored(lines, stored).select("transaction_id", "record_hash", "event_date")


def first_file_wins(spark: SparkSession, folder: str) -> DataFrame:
    hashed = hashed_lines(spark, folder).withColumn("record_hash", F.unhex("record_hash"))
    lines = stage(hashed.select("transaction_id", "record_hash", "status", "line_status"), "hashed-lines")
    original = lines.filter("status <> 'REVERSED'").withColumn("source_file", F.lit("a.csv"))
    repeated = original.filter("line_status = 'F'")
    resubmitted = lines.withColumn("source_file", F.lit("b.csv"))
    kept = first_delivery_wins(original.unionByName(repeated).unionByName(resubmitted))
    counts = kept.groupBy("transaction_id", "record_hash", "source_file").agg(F.count(F.lit(1)).alias("copies"))
    return counts.withColumn("record_hash", F.lower(F.hex("record_hash")))


# --- text, types and hashes over events -----------------------------------------


def landing(folder: str) -> Landing:
    return Landing(folder, unit="folder")


def soiled(spark: SparkSession, folder: str) -> DataFrame:
    return views.soiled_times(views.soiled_amounts(views.event_payments_text(spark, folder)))


def cast_amount(spark: SparkSession, folder: str) -> DataFrame:
    return type_payments(soiled(spark, folder)).select("transaction_id", "amount")


def cast_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    typed = type_payments(soiled(spark, folder))
    return typed.select("transaction_id", F.unix_micros("transaction_ts").cast("string").alias("transaction_micros"))


def derive_event_date(spark: SparkSession, folder: str) -> DataFrame:
    return type_payments(soiled(spark, folder)).select("transaction_id", "event_date")


def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    return type_payments(soiled(spark, folder)).select("transaction_id", row_fate().alias("fate"))


def backfill_filter(spark: SparkSession, folder: str) -> DataFrame:
    typed = type_payments(soiled(spark, folder))
    return accepted(typed.withColumn("fate", row_fate(BACKFILL))).select("transaction_id", "event_date", "amount")


def typed_events(spark: SparkSession, folder: str) -> DataFrame:
    return type_payments(views.soiled_amounts(views.event_payments_text(spark, folder)))


def hash_rows(spark: SparkSession, folder: str) -> DataFrame:
    typed = typed_events(spark, folder)
    return typed.select("transaction_id", record_hash(typed, [*PAYMENT_COLUMNS, "event_date"]).alias("record_hash"))


def enrich_metadata(spark: SparkSession, folder: str) -> DataFrame:
    typed = typed_events(spark, folder)
    helpers = [c for c in typed.columns if c not in (*PAYMENT_COLUMNS, "event_date")]
    source = F.concat(F.col("delivery"), F.lit(".csv"))
    return enrich(typed, source, "run-1", FIRST_RUN, exclude=helpers).select(
        "transaction_id",
        "record_hash",
        F.unix_micros("ingest_ts").alias("ingest_micros"),
        "ingest_run_id",
        "source_file",
    )


def merchant_typing(spark: SparkSession, folder: str) -> DataFrame:
    return type_merchants(views.customer_merchants(spark, folder)).select(
        "merchant_id",
        "merchant_name",
        F.col("onboarding_date").cast("string").alias("onboarding_date"),
        F.col("is_active").cast("string").alias("is_active"),
    )


def pii_free_projection(spark: SparkSession, folder: str) -> DataFrame:
    audit = views.event_payments_text(spark, folder)
    typed = type_payments(audit).withColumn("ingest_ts", F.col("transaction_ts"))
    return reports.current_payments(typed).withColumn("event_date", F.col("event_date").cast("string"))


def code_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Payments per method, with some of a method no report knows, and whether a report may be about that method."""
    lines = views.line_payments(spark, folder)
    method = F.when(F.col("part") % 7 == 0, F.lit("CASH")).otherwise(F.col("payment_method"))
    counts = lines.groupBy(method.alias("payment_method")).agg(F.count(F.lit(1)).alias("payments"))

    def allowed(name: str) -> str:
        try:
            reports.ReportRules(payment_method=name)
        except ValueError:
            return "false"
        return "true"

    rows = [(r[0], allowed(r[0])) for r in counts.select("payment_method").collect()]
    return counts.join(spark.createDataFrame(rows, "payment_method string, allowed string"), "payment_method")


def empty_write(spark: SparkSession, folder: str) -> DataFrame:
    """Appending no rows writes nothing, appending all of them afterwards a table."""
    path = staging_path(spark, "flat")
    lines = views.line_payments(spark, folder).select("status", "amount")
    append_flat(lines.filter("amount < 0"), path)
    there = str(path_exists(spark, path)).lower()
    append_flat(lines, path)
    stored = read_table(spark, path, "status string, amount double")
    return stored.groupBy("status").agg(F.count(F.lit(1)).alias("rows"), F.lit(there).alias("written_before"))


# --- deliveries -----------------------------------------------------------------


def landed(spark: SparkSession, text: DataFrame, label: str, **options) -> Landing:
    path = staging_path(spark, label)
    views.write_deliveries(text, path, PAYMENT_COLUMNS, **options)
    return landing(path)


def csv_scan_strings(spark: SparkSession, folder: str) -> DataFrame:
    drop = landed(spark, views.event_payments_text(spark, folder), "csv")
    return read_deliveries(spark, drop).select(*PAYMENT_COLUMNS)


def csv_lineage_counts(spark: SparkSession, folder: str) -> DataFrame:
    drop = landed(spark, views.event_payments_text(spark, folder), "csv")
    return read_deliveries(spark, drop).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def with_overflow(text: DataFrame) -> DataFrame:
    """Week 2 gets rows with one field too many, if written without quotes."""
    long_row = (F.col("delivery") == "week2") & (F.col("status") == "REVERSED")
    return text.withColumn(
        "gateway_ref", F.when(long_row, F.concat("gateway_ref", F.lit(",surplus"))).otherwise(F.col("gateway_ref"))
    )


def csv_skip_bad_files(spark: SparkSession, folder: str) -> DataFrame:
    drop = landed(spark, with_overflow(views.event_payments_text(spark, folder)), "csv", quote="")
    return read_deliveries(spark, drop).select("source_file", "transaction_id", "amount", "gateway_ref")


def mixed_headers(spark: SparkSession, text: DataFrame) -> Landing:
    """Weeks 1 to 3 with the agreed header, week 4 with one column more, week 5 without amounts."""
    path = staging_path(spark, "csv")
    views.write_deliveries(text.filter("delivery < 'week4'"), path, PAYMENT_COLUMNS)
    views.write_deliveries(text.filter("delivery = 'week4'"), path, ["device", *reversed(PAYMENT_COLUMNS)])
    partial = [c for c in PAYMENT_COLUMNS if c not in ("amount", "currency")]
    views.write_deliveries(text.filter("delivery = 'week5'"), path, [*partial, "device"])
    return landing(path)


def csv_schema_gate(spark: SparkSession, folder: str) -> DataFrame:
    drop = mixed_headers(spark, views.event_payments_text(spark, folder))
    checked = gate_report(read_landing(spark, drop), PAYMENT_COLUMNS)
    return checked.withColumn("passed", F.col("passed").cast("string"))


# --- jobs -----------------------------------------------------------------------


def resubmitted(text: DataFrame) -> DataFrame:
    """A resubmission of weeks 1 and 2 that sorts between the two."""
    again = text.filter("delivery IN ('week1', 'week2')").withColumn("delivery", F.lit("week1_resubmit"))
    return text.unionByName(again)


def bronze(spark: SparkSession, drop: Landing, **options) -> str:
    path = staging_path(spark, "bronze")
    ingest_payments(spark, drop, path, ingest_ts=FIRST_RUN, **options)
    return path


def event_bronze(spark: SparkSession, folder: str) -> str:
    return bronze(spark, landed(spark, views.event_payments_text(spark, folder), "csv"))


def bronze_ingest_counts(spark: SparkSession, folder: str) -> DataFrame:
    drop = landed(spark, resubmitted(soiled(spark, folder)), "csv")
    result = ingest_payments(spark, drop, staging_path(spark, "bronze"))
    return result.counts.drop("missing_columns", "rows_out_of_range")


def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    stored = read_bronze(spark, event_bronze(spark, folder))
    return stored.select(
        *[c for c in PAYMENT_COLUMNS if c != "transaction_ts"],
        F.unix_micros("transaction_ts").alias("transaction_micros"),
        "event_date",
        "record_hash",
        "source_file",
    )


def idempotent_rerun(spark: SparkSession, folder: str) -> DataFrame:
    text = views.event_payments_text(spark, folder)
    path = staging_path(spark, "bronze")
    first = landed(spark, text, "csv")
    ingest_payments(spark, first, path, ingest_ts=FIRST_RUN)
    ingest_payments(spark, first, path, ingest_ts=LATER_RUN)
    ingest_payments(spark, landed(spark, resubmitted(text), "csv"), path, ingest_ts=LATER_RUN)
    return read_bronze(spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("record_hash").alias("hashes")
    )


def run_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs that were given no id, the later with all deliveries: rows of each, under ids of their own."""
    text = views.event_payments_text(spark, folder)
    path = staging_path(spark, "bronze")
    ingest_payments(spark, landed(spark, text.filter("delivery < 'week4'"), "csv"), path, ingest_ts=FIRST_RUN)
    ingest_payments(spark, landed(spark, text, "csv"), path, ingest_ts=LATER_RUN)
    runs = read_bronze(spark, path).groupBy("ingest_run_id", "ingest_ts").agg(F.count(F.lit(1)).alias("rows"))
    return runs.select(F.date_format("ingest_ts", "yyyy-MM-dd").alias("ingest_day"), "rows")


def scan_partition_prune(spark: SparkSession, folder: str) -> DataFrame:
    path = event_bronze(spark, folder)
    return read_bronze(spark, path, BACKFILL.days(), ["transaction_id", "amount", "event_date"])


def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    return read_bronze(spark, event_bronze(spark, folder), columns=["transaction_id", "status"])


def schema_evolution_union(spark: SparkSession, folder: str) -> DataFrame:
    text = views.event_payments_text(spark, folder)
    path = bronze(spark, mixed_headers(spark, text))
    return read_evolved(spark, path).select("transaction_id", "amount", "event_date", "device")


def merchant_dedup(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "bronze-merchants")
    merchants = views.customer_merchants(spark, folder)
    for version in (merchants.withColumn("is_active", F.lit("true")), merchants, merchants):
        drop = staging_path(spark, "merchants-csv")
        version.drop("c_acctbal").write.option("header", True).option("escape", '"').csv(drop)
        ingest_merchants(spark, drop, path)
    return read_bronze_merchants(spark, path).groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("versions"), F.count_if("is_active").alias("active_versions")
    )


def audited_run(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Ingest with good, soiled, overflowing and incomplete deliveries; paths of manifest and report."""
    text = with_overflow(soiled(spark, folder))
    path = staging_path(spark, "csv")
    views.write_deliveries(text.filter("delivery NOT IN ('week2', 'week5')"), path, PAYMENT_COLUMNS)
    views.write_deliveries(text.filter("delivery = 'week2'"), path, PAYMENT_COLUMNS, quote="")
    partial = [c for c in PAYMENT_COLUMNS if c != "amount"]
    views.write_deliveries(text.filter("delivery = 'week5'"), path, partial)
    manifest, report = staging_path(spark, "manifest"), staging_path(spark, "report")
    ingest_payments(
        spark, landing(path), staging_path(spark, "bronze"), run_id="run-1", manifest_path=manifest, report_path=report
    )
    return manifest, report


def audit_file_counts(spark: SparkSession, folder: str) -> DataFrame:
    return read_manifest(spark, audited_run(spark, folder)[0]).drop("run_ts", "rows_out_of_range", "extra")


def audit_stage_report(spark: SparkSession, folder: str) -> DataFrame:
    report = read_report(spark, audited_run(spark, folder)[1])
    return report.drop("start_ts", "end_ts", "duration_seconds")


def event_audit(spark: SparkSession, folder: str) -> DataFrame:
    typed = type_payments(views.event_payments_text(spark, folder))
    return typed.withColumn("ingest_ts", F.lit(FIRST_RUN))


def gold_partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    audit = event_audit(spark, folder)
    merchants = views.event_merchants(spark, folder)
    path = staging_path(spark, "daily")

    def summary(payments: DataFrame) -> DataFrame:
        totals = reports.daily_totals(reports.current_payments(payments))
        return reports.daily_payment_summary(totals, merchants)

    overwrite_partitions(summary(audit), path, "event_date")
    corrected = audit.filter(BACKFILL.holds(F.col("event_date"))).filter("status <> 'PENDING'")
    overwrite_partitions(summary(corrected), path, "event_date")
    return read_table(spark, path, DAILY_SUMMARY_DDL)


def written_reports(spark: SparkSession, folder: str) -> dict[str, str]:
    paths = {name: staging_path(spark, name) for name in ("daily_payment_summary", "merchant_performance_7d")}
    merchants = staging_path(spark, "merchants-csv")
    views.event_merchants(spark, folder).write.option("header", True).option("escape", '"').csv(merchants)
    stored = event_bronze(spark, folder)
    build_reports(spark, stored, merchants, *paths.values())
    return {"bronze_payments": stored, **paths}


def adhoc_gold_select(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, written_reports(spark, folder))
    return spark.sql(
        "SELECT event_date, merchant_id, currency, status, transaction_count, total_amount "
        "FROM daily_payment_summary "
        "ORDER BY event_date, merchant_id NULLS LAST, currency NULLS LAST, status NULLS LAST"
    )


def adhoc_rows_per_date(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, {"bronze_payments": event_bronze(spark, folder)})
    return spark.sql(
        "SELECT event_date, count(*) AS rows FROM bronze_payments GROUP BY event_date ORDER BY event_date"
    )


def quarantine_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Soiled deliveries ingested twice, then resubmitted: each row set aside is stored once."""
    text = soiled(spark, folder)
    path, aside = staging_path(spark, "bronze"), staging_path(spark, "quarantine")
    first = landed(spark, text, "csv")
    for drop in (first, first, landed(spark, resubmitted(text), "csv")):
        ingest_payments(spark, drop, path, quarantine_path=aside)
    return spark.read.parquet(aside).groupBy("transaction_id", "reason").agg(F.count(F.lit(1)).alias("rows"))


def audit_empty_run(spark: SparkSession, folder: str) -> DataFrame:
    """All deliveries, and beside each one another that has a header and no row."""
    path, manifest = staging_path(spark, "csv"), staging_path(spark, "manifest")
    text = views.event_payments_text(spark, folder)
    views.write_deliveries(text, path, PAYMENT_COLUMNS)
    header = F.lit(",".join(PAYMENT_COLUMNS)).alias("value")
    void = text.select("delivery").distinct().select(header, F.concat(F.lit("void-"), "delivery").alias("delivery"))
    void.write.mode("append").partitionBy("delivery").text(path)
    ingest_payments(
        spark, Landing(path, pattern="*.{csv,txt}", unit="folder"), staging_path(spark, "bronze"), run_id="run-1", manifest_path=manifest
    )
    return read_manifest(spark, manifest).drop("run_ts", "rows_out_of_range", "extra", "missing_columns")


def adhoc_performance_select(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, written_reports(spark, folder))
    return spark.sql(
        "SELECT snapshot_date, merchant_id, total_transactions_7d, total_approved_amount_7d, active_days_7d "
        "FROM merchant_performance_7d ORDER BY snapshot_date, merchant_id NULLS LAST"
    )


def strict_contract_report(spark: SparkSession, folder: str) -> DataFrame:
    """A report whose contract names a column it lacks is not written; the run says so."""
    stored = event_bronze(spark, folder)
    merchants, report = staging_path(spark, "merchants-csv"), staging_path(spark, "report")
    views.event_merchants(spark, folder).write.option("header", True).option("escape", '"').csv(merchants)
    build_reports(
        spark, stored, merchants, staging_path(spark, "daily"), staging_path(spark, "performance"),
        run_id="run-1", report_path=report, daily_contract=["event_date", "fee"],
    )
    return read_report(spark, report).drop("start_ts", "end_ts", "duration_seconds")


def failed_run_report(spark: SparkSession, folder: str) -> DataFrame:
    """A landing folder that breaks its promised header fails the run, which is reported."""
    report = staging_path(spark, "report")
    drop = landed(spark, views.event_payments_text(spark, folder), "csv")
    try:
        ingest_payments(
            spark, drop, staging_path(spark, "bronze"), run_id="run-1", report_path=report, columns=["transaction_id"]
        )
    except ValueError:
        pass
    return read_report(spark, report).drop("start_ts", "end_ts", "duration_seconds")


def backfill_rolling_lookback(spark: SparkSession, folder: str) -> DataFrame:
    """Full build, late status changes for some days, backfill of just these days."""
    text = views.event_payments_text(spark, folder)
    stored = bronze(spark, landed(spark, text, "csv"))
    merchants = staging_path(spark, "merchants-csv")
    views.event_merchants(spark, folder).write.option("header", True).option("escape", '"').csv(merchants)
    daily, performance = staging_path(spark, "daily"), staging_path(spark, "performance")
    build_reports(spark, stored, merchants, daily, performance)
    changed = text.filter(F.substring("transaction_ts", 1, 10).between(BACKFILL.first, BACKFILL.last))
    late = changed.filter("status = 'PENDING'").withColumns({"status": F.lit("REVERSED"), "delivery": F.lit("late")})
    ingest_payments(spark, landed(spark, late, "csv"), stored, ingest_ts=LATER_RUN)
    build_reports(spark, stored, merchants, daily, performance, dates=BACKFILL)
    return read_table(spark, performance, performance_ddl(7))


# --- state kept beside the audit table ----------------------------------------------


def moved_later(text: DataFrame) -> DataFrame:
    """Later versions of the pending payments of some days: reversed, every other one on another day."""
    pending = text.filter(F.substring("transaction_ts", 1, 10).between(BACKFILL.first, BACKFILL.last)).filter("status = 'PENDING'")
    when = F.when(F.col("event_id") % 2 == 0, F.lit("2024-01-20 12:00:00.000000")).otherwise(F.col("transaction_ts"))
    return pending.withColumns({"status": F.lit("REVERSED"), "transaction_ts": when, "delivery": F.lit("late")})


def current_state_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Current payments stored once, then merged with later versions that came after."""
    text = views.event_payments_text(spark, folder)
    stored = bronze(spark, landed(spark, text, "csv"))
    refresh_current(spark, stored, "run-1")
    ingest_payments(spark, landed(spark, moved_later(text), "csv"), stored, ingest_ts=LATER_RUN)
    refresh_current(spark, stored, "run-2")
    return current_state(spark, stored)


def published_reports(spark: SparkSession, folder: str) -> tuple[str, str, Publication]:
    """Audit table, merchant file and published reports of all events."""
    stored, merchants = event_bronze(spark, folder), staging_path(spark, "merchants-csv")
    views.event_merchants(spark, folder).write.option("header", True).option("escape", '"').csv(merchants)
    names = ("daily_payment_summary", "merchant_performance_7d")
    published = Publication(staging_path(spark, "published"), {n: staging_path(spark, n) for n in names})
    update_reports(spark, stored, merchants, published)
    return stored, merchants, published


def incremental_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reports brought up to date after later versions came, by the days these touch."""
    stored, merchants, published = published_reports(spark, folder)
    late = moved_later(views.event_payments_text(spark, folder))
    ingest_payments(spark, landed(spark, late, "csv"), stored, ingest_ts=LATER_RUN)
    update_reports(spark, stored, merchants, published)
    return published.read(spark, "merchant_performance_7d", performance_ddl(7), "snapshot_date")


def publish_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """A run that wrote one of both reports and broke off has changed nothing that is read."""
    _, _, published = published_reports(spark, folder)
    before = published.read(spark, "daily_payment_summary", DAILY_SUMMARY_DDL, "event_date")
    doubled = before.withColumn("transaction_count", F.col("transaction_count") * 2)
    published.write(doubled, "daily_payment_summary", "broken-off", "event_date")
    return published.read(spark, "daily_payment_summary", DAILY_SUMMARY_DDL, "event_date")


def damage(spark: SparkSession, pattern: str) -> None:
    """Overwrite files with something that is no table."""
    location = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in system.globStatus(location):
        stream = system.create(found.getPath(), True)
        stream.write(bytearray(b"PAR1 no table PAR1"))
        stream.close()


def bronze_damaged_file(spark: SparkSession, folder: str) -> DataFrame:
    """The audit files of one day are damaged: the ledger tells which, and the report goes without that day."""
    stored, merchants = event_bronze(spark, folder), staging_path(spark, "merchants-csv")
    views.event_merchants(spark, folder).write.option("header", True).option("escape", '"').csv(merchants)
    damage(spark, f"{stored}/event_date={BACKFILL.first}/*.parquet")
    daily = staging_path(spark, "daily")
    build_reports(spark, stored, merchants, daily, staging_path(spark, "performance"), set_aside_damaged=True)
    return read_table(spark, daily, DAILY_SUMMARY_DDL)


QUERIES = {
    "daily_payment_summary": daily_payment_summary,
    "merchant_performance_7d": merchant_performance(7),
    "merchant_performance_30d": merchant_performance(30),
    "merchant_performance_1d": merchant_performance(1),
    "merchant_performance_90d": merchant_performance(90),
    "latest_status_per_txn": latest_status_per_txn,
    "exact_sums": exact_sums,
    "code_lists": code_lists,
    "empty_write": empty_write,
    "run_ids": run_ids,
    "approval_rate": approval_rate,
    "reversal_rate": reversal_rate,
    "active_days": active_days,
    "date_merchant_spine": date_merchant_spine,
    "left_join_dimension": left_join,
    "dedup_anti_join": dedup_anti_join,
    "first_file_wins": first_file_wins,
    "cast_amount": cast_amount,
    "cast_timestamp": cast_timestamp,
    "derive_event_date": derive_event_date,
    "quarantine_split": quarantine_split,
    "backfill_filter": backfill_filter,
    "record_hash": hash_rows,
    "enrich_metadata": enrich_metadata,
    "merchant_typing": merchant_typing,
    "pii_free_projection": pii_free_projection,
    "csv_scan_strings": csv_scan_strings,
    "csv_lineage_counts": csv_lineage_counts,
    "csv_skip_bad_files": csv_skip_bad_files,
    "csv_schema_gate": csv_schema_gate,
    "bronze_ingest_counts": bronze_ingest_counts,
    "bronze_roundtrip": bronze_roundtrip,
    "idempotent_rerun": idempotent_rerun,
    "scan_partition_prune": scan_partition_prune,
    "scan_project": scan_project,
    "schema_evolution_union": schema_evolution_union,
    "merchant_dedup": merchant_dedup,
    "audit_file_counts": audit_file_counts,
    "audit_stage_report": audit_stage_report,
    "gold_partition_overwrite": gold_partition_overwrite,
    "adhoc_gold_select": adhoc_gold_select,
    "adhoc_rows_per_date": adhoc_rows_per_date,
    "adhoc_performance_select": adhoc_performance_select,
    "quarantine_rerun": quarantine_rerun,
    "audit_empty_run": audit_empty_run,
    "strict_contract_report": strict_contract_report,
    "failed_run_report": failed_run_report,
    "backfill_rolling_lookback": backfill_rolling_lookback,
    "current_state_merge": current_state_merge,
    "incremental_reports": incremental_reports,
    "publish_after_failure": publish_after_failure,
    "bronze_damaged_file": bronze_damaged_file,
}
