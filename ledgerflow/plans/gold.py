"""The report job: audit table to both report tables, by partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.layout import BRONZE_PAYMENTS_DDL, DAILY_SUMMARY_COLUMNS, performance_columns
from ledgerflow.operators.contracts import check_columns, check_unique
from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.enrich import new_run_id
from ledgerflow.operators.joins import broadcast_if_small
from ledgerflow.plans.audit import FAILED, PARTIAL, SUCCESS, StageReport, track_stage
from ledgerflow.operators.dedup import VERSION_TIE_BREAKERS
from ledgerflow.plans.reports import (
    REPORT_INPUT,
    ReportRules,
    current_payments,
    daily_payment_summary,
    daily_totals,
    merchant_performance,
)
from ledgerflow.plans.state import Refreshed, current_state, publication, refresh_current
from ledgerflow.session import apply_job_settings, path_exists, sized_shuffles, stage, staging_of_run
from ledgerflow.sources.indexes import days_of, transaction_days
from ledgerflow.sources.ledger import checksum, damaged_by_content, damaged_by_listing, expected_shape, state_path
from ledgerflow.sources.tables import damaged_files, overwrite_partitions, read_bronze, read_merchant_lookup
from ledgerflow.sources.versions import Publication, holds_any


@dataclass
class GoldResult:
    """Status of a run, the rows read and written per report table, and the files set aside as damaged."""

    run_id: str
    status: str = SUCCESS
    tables: dict[str, dict] = field(default_factory=dict)
    damaged: DataFrame | None = None
    refreshed: Refreshed | None = None


def backfill_payments(audit: DataFrame, dates: DateRange, index: DataFrame | None = None) -> DataFrame:
    """Newest versions of the payments that belong to `dates`.

    A newer version may lie in another partition, so every version of the
    transactions seen in the range takes part. The index of transactions tells
    the days that hold any of them (without it, a scan of ids and dates), and
    only those partitions are read for the versions. The ids are staged, so that AQE can split an id with very many
    versions; those of a small backfill are broadcast.
    """
    touched = stage(
        audit.filter(dates.holds(F.col("event_date"))).select(F.col("transaction_id").alias("_id")).distinct(), "touched-ids"
    )
    ids = broadcast_if_small(touched)
    same_id = F.col("transaction_id").eqNullSafe(F.col("_id"))
    if index is None:
        days = audit.select("transaction_id", "event_date").join(ids, same_id, "left_semi").select("event_date").distinct()
        held = [row[0] for row in days.collect()]
    else:
        held = days_of(index, ids.select(F.xxhash64("_id").alias("id_hash")))
    versions = audit.filter(F.col("event_date").isin(held)).join(ids, same_id, "left_semi")
    return current_payments(versions).filter(dates.holds(F.col("event_date")))


def observed(audit: DataFrame, seen: Observation) -> DataFrame:
    """Audit rows with what reports read of them; `seen` gets their number and checksum as they are read."""
    narrow = audit.select(*dict.fromkeys([*REPORT_INPUT, "ingest_ts", *VERSION_TIE_BREAKERS]))
    return narrow.observe(seen, F.count(F.lit(1)).alias("rows"), checksum().alias("checksum"))


def write_report(
    df: DataFrame, path: str, partition: str, contract: Sequence[str], result: GoldResult, report: StageReport,
    name: str, rows_read: int,
) -> None:
    """Overwrite the partitions of `df` unless its columns break the contract."""
    spark = df.sparkSession
    checked = check_columns(df.columns, contract, name, strict=True)
    if not checked:
        result.status = PARTIAL
        result.tables[name] = {"rows_read": rows_read, "rows_written": 0, "schema_error": checked.message}
        report.record_table(spark, name, rows_read, quarantined=rows_read)
        return
    # Counted by the write itself, in its final stage.
    written = Observation(name)
    overwrite_partitions(df, path, partition, written)
    rows = written.get["rows"]
    result.tables[name] = {"rows_read": rows_read, "rows_written": rows}
    report.record_table(spark, name, rows_read, rows)


def build_reports(
    spark: SparkSession,
    bronze_path: str,
    merchants_path: str,
    daily_path: str,
    performance_path: str,
    *,
    rules: ReportRules = ReportRules(),
    run_id: str | None = None,
    dates: DateRange | None = None,
    set_aside_damaged: bool = False,
    report_path: str | None = None,
    daily_contract: Sequence[str] = DAILY_SUMMARY_COLUMNS,
    performance_contract: Sequence[str] | None = None,
) -> GoldResult:
    """Rebuild both reports, or only what a backfill of `dates` can change.

    A backfill rewrites the daily partitions of `dates` and the snapshots whose
    window touches them, from payments that include the look-back of the first
    snapshot.

    A damaged file fails the run. With `set_aside_damaged` such files are listed
    in the result, the run is PARTIAL, and no day or snapshot is overwritten
    whose payments lie in their partitions.
    """
    apply_job_settings(spark)
    result = GoldResult(run_id or new_run_id())
    reach = rules.window_days - 1
    stored = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
    with (
        staging_of_run(spark),
        track_stage(spark, result.run_id, "gold", report_path) as report,
        sized_shuffles(spark, bronze_path, stored),
    ):
        lost_days: list[str] = []
        lost, expected = None, None
        if set_aside_damaged and path_exists(spark, bronze_path):
            known = path_exists(spark, state_path(bronze_path, "files"))
            # What a full build reads is held against the ledger; only a difference has its files looked for.
            expected = expected_shape(spark, bronze_path) if known and dates is None else None
            if expected is not None:
                lost = damaged_by_listing(spark, bronze_path)
            elif known:
                lost = damaged_by_listing(spark, bronze_path).unionByName(damaged_by_content(spark, bronze_path)).distinct()
            else:
                lost = damaged_files(spark, bronze_path, BRONZE_PAYMENTS_DDL)
            lost = stage(lost, "damaged")
        audit = read_bronze(spark, bronze_path, skip_corrupt=set_aside_damaged)
        daily_dates = snapshot_dates = dates
        if dates is None:
            rows_read = audit.count()
        else:
            snapshot_dates = dates.widened(after=reach)
            lookback = dates.widened(before=reach, after=reach)
            rows_read = audit.filter(lookback.holds(F.col("event_date"))).count()
        seen = Observation("seen")
        # The count reads file footers alone.
        if rows_read == 0:
            report.failed = True
            result.status = FAILED
            return result
        current = (
            current_payments(audit if expected is None else observed(audit, seen))
            if dates is None
            else backfill_payments(audit, lookback, transaction_days(spark, bronze_path))
        )
        # Both reports read the totals, and so does the calendar of snapshots.
        totals = stage(daily_totals(current, rules.payment_method), "daily-totals")

        if lost is not None:
            if expected is not None and (seen.get["rows"], int(seen.get["checksum"])) != expected:
                lost = stage(lost.unionByName(damaged_by_content(spark, bronze_path)).distinct(), "damaged")
            lost_days = [r[0].removeprefix("event_date=") for r in lost.select("folder").distinct().collect()]
        if lost_days:
            result.status = PARTIAL
            # The list outlives the run's staged tables.
            result.damaged = stage(lost.select("path").orderBy("path"), "damaged-files", keep=True)
            report.record(
                stage(
                    lost.groupBy(F.concat(F.lit("damaged files in "), "folder").alias("table_name")).agg(
                        F.lit(0).cast("bigint").alias("rows_read"),
                        F.lit(0).cast("bigint").alias("rows_written"),
                        F.count(F.lit(1)).alias("rows_quarantined"),
                    ),
                    "damaged-report",
                    keep=True,
                )
            )

        merchants = stage(read_merchant_lookup(spark, merchants_path), "merchant-lookup")
        check_unique(merchants, "merchant_id", "merchant lookup")
        daily = daily_payment_summary(totals, merchants, rules)
        performance = merchant_performance(totals, merchants, rules)
        if dates is not None:
            daily = daily.filter(daily_dates.holds(F.col("event_date")))
            performance = performance.filter(snapshot_dates.holds(F.col("snapshot_date")))
        if lost_days:
            touched = [day for lost_day in lost_days for day in DateRange(lost_day, lost_day).widened(after=reach).days()]
            daily = daily.filter(~F.col("event_date").isin(lost_days))
            performance = performance.filter(~F.col("snapshot_date").isin(touched))

        write_report(
            daily, daily_path, "event_date", daily_contract, result, report, "daily_payment_summary", rows_read
        )
        write_report(
            performance, performance_path, "snapshot_date",
            performance_contract or performance_columns(rules.window_days),
            result, report, f"merchant_performance_{rules.window_days}d", rows_read,
        )
    return result


def update_reports(
    spark: SparkSession,
    bronze_path: str,
    merchants_path: str,
    reports: Publication,
    *,
    rules: ReportRules = ReportRules(),
    run_id: str | None = None,
    report_path: str | None = None,
) -> GoldResult:
    """Bring both published reports up to the audit table by rewriting only what new payments can change.

    The stored current payments are refreshed first; the days they changed decide which daily partitions and
    which snapshots are built again, from the totals of those days and their look-back. Both tables of
    `reports` (`daily_payment_summary` and the performance table) become visible together.

    A change of the merchant lookup or of the rules concerns all days: publish a first build under a new pointer.
    """
    apply_job_settings(spark)
    result = GoldResult(run_id or new_run_id())
    names = ("daily_payment_summary", f"merchant_performance_{rules.window_days}d")
    stored = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
    with (
        staging_of_run(spark),
        track_stage(spark, result.run_id, "gold", report_path) as report,
        sized_shuffles(spark, bronze_path, stored),
    ):
        known, built = reports.state(spark), f"payment_versions_{rules.window_days}d"
        refreshed = refresh_current(spark, bronze_path, result.run_id)
        # Days that an earlier run refreshed without publishing its reports are due as well.
        versions = publication(bronze_path).state(spark).get("current", {})
        done = known.get(built, {})
        due = sorted(day for day in {*versions, *done} if versions.get(day) != done.get(day))
        if not versions and not known:
            report.failed = True
            result.status = FAILED
            return result
        affected = _widened(due, 0, rules.window_days - 1)
        lookback = _widened(affected, rules.window_days - 1, 0)
        current = current_state(spark, bronze_path).filter(holds_any("event_date", lookback))
        current = current.withColumn("event_date", F.col("event_date").cast("date"))
        totals = stage(daily_totals(current, rules.payment_method), "daily-totals")
        rows_read = int(totals.agg(F.sum("payments")).first()[0] or 0)
        merchants = stage(read_merchant_lookup(spark, merchants_path), "merchant-lookup")
        check_unique(merchants, "merchant_id", "merchant lookup")
        daily = daily_payment_summary(totals, merchants, rules).filter(holds_any("event_date", due))
        performance = merchant_performance(totals, merchants, rules).filter(holds_any("snapshot_date", affected))
        changes: dict[str, dict[str, str | None]] = {built: {day: versions.get(day) for day in due}}
        for name, df, partition, days in zip(
            names, (daily, performance), ("event_date", "snapshot_date"), (due, affected), strict=True
        ):
            written = Observation(name)
            changes[name] = dict.fromkeys(days) | reports.write(df, name, result.run_id, partition, written)
            rows = written.get["rows"]
            result.tables[name] = {"rows_read": rows_read, "rows_written": rows}
            report.record_table(spark, name, rows_read, rows)
        reports.publish(spark, changes)
        result.refreshed = refreshed
    return result


def _widened(days: Sequence[str], before: int, after: int) -> list[str]:
    """These days and so many before and after each."""
    return sorted({d for day in days for d in DateRange(day, day).widened(before, after).days()})
