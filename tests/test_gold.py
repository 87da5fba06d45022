from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest

from ledgerflow.__main__ import main
from ledgerflow.layout import DAILY_SUMMARY_DDL, performance_ddl
from ledgerflow.operators.dates import DateRange
from ledgerflow.plans.audit import read_report
from ledgerflow.plans.bronze import ingest_payments
from ledgerflow.plans.gold import build_reports
from ledgerflow.plans.pipeline import Lake, run_pipeline
from ledgerflow.plans.reports import ReportRules
from ledgerflow.sources.deliveries import Landing
from ledgerflow.sources.columns import register_views
from ledgerflow.sources.tables import overwrite_partitions, read_merchant_lookup, read_table
from payments import merchant, payment, write_csv, write_merchants


class Shop:
    """A lake with its merchants, for building reports."""

    def __init__(self, spark, root):
        self.spark, self.root, self.runs = spark, root, 0
        self.merchants = str(write_merchants(root / "merchants.csv", [merchant("M1"), merchant("M2")]))
        self.bronze, self.daily_path, self.performance_path = (str(root / n) for n in ("bronze", "daily", "perf"))

    def load(self, rows):
        self.runs += 1
        folder = self.root / f"in{self.runs}"
        write_csv(folder / "d.csv", rows)
        when = datetime(2024, 2, 1, tzinfo=timezone.utc) + timedelta(self.runs)
        ingest_payments(self.spark, Landing(str(folder)), self.bronze, ingest_ts=when)

    def build(self, **options):
        return build_reports(
            self.spark, self.bronze, self.merchants, self.daily_path, self.performance_path, **options
        )

    def daily(self):
        table = read_table(self.spark, self.daily_path, DAILY_SUMMARY_DDL)
        return {(r["event_date"], r["merchant_id"], r["status"]): r["transaction_count"] for r in table.collect()}

    def performance(self, days=7):
        table = read_table(self.spark, self.performance_path, performance_ddl(days))
        return {(r["snapshot_date"], r["merchant_id"]): r for r in table.collect()}


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def dated(number, day, **values):
    return payment(f"T{number}", transaction_ts=f"{day} 10:00:00", **values)


def test_build_writes_both_tables(spark, shop):
    shop.load([dated(1, "2024-01-15"), dated(2, "2024-01-16", merchant_id="M2"), dated(3, "2024-01-16", merchant_id="M9")])
    report = str(shop.root / "report")
    result = shop.build(run_id="run-1", report_path=report)
    assert result.status == "SUCCESS"
    assert result.tables == {
        "daily_payment_summary": {"rows_read": 3, "rows_written": 3},
        "merchant_performance_7d": {"rows_read": 3, "rows_written": 4},
    }
    assert len(shop.daily()) == 3
    names = {r["merchant_id"]: r["merchant_name"] for r in shop.performance().values()}
    assert names == {"M1": "Shop M1", "M2": "Shop M2", "M9": None}
    rows = {r["table_name"]: (r["rows_read"], r["rows_written"], r["status"]) for r in read_report(spark, report).collect()}
    assert rows["merchant_performance_7d"] == (3, 4, "SUCCESS")


def test_rebuild_gives_the_same_tables(shop):
    shop.load([dated(n, f"2024-01-{10 + n % 5}") for n in range(20)])
    shop.build()
    before = shop.daily(), shop.performance()
    shop.build()
    assert (shop.daily(), shop.performance()) == before


def test_nothing_stored_fails(spark, shop):
    report = str(shop.root / "report")
    assert shop.build(report_path=report).status == "FAILED"
    assert [r["status"] for r in read_report(spark, report).collect()] == ["FAILED"]


def test_broken_contract_blocks_the_table(shop):
    shop.load([dated(1, "2024-01-15")])
    result = shop.build(daily_contract=["event_date", "risk_score"])
    assert result.status == "PARTIAL"
    assert result.tables["daily_payment_summary"]["rows_written"] == 0
    assert "missing columns: risk_score" in result.tables["daily_payment_summary"]["schema_error"]
    assert result.tables["merchant_performance_7d"]["rows_written"] == 1
    assert shop.daily() == {}


def test_repeated_merchants_stop_the_build(shop):
    shop.load([dated(1, "2024-01-15")])
    write_merchants(shop.root / "merchants.csv", [merchant("M1"), merchant("M1", merchant_name="Again")])
    with pytest.raises(ValueError, match="not unique"):
        shop.build()


def test_missing_merchant_file_leaves_names_empty(spark, shop):
    shop.load([dated(1, "2024-01-15")])
    assert read_merchant_lookup(spark, str(shop.root / "none.csv")).count() == 0
    shop.merchants = str(shop.root / "none.csv")
    assert shop.build().status == "SUCCESS"
    assert shop.performance()["2024-01-15", "M1"]["merchant_name"] is None


def test_rules_are_checked():
    with pytest.raises(ValueError, match="window_days"):
        ReportRules(window_days=0)
    with pytest.raises(ValueError, match="status"):
        ReportRules(reversed_status="UNDONE")


def test_rules_change_the_reports(shop):
    shop.load([dated(1, "2024-01-15", payment_method="WALLET"), dated(2, "2024-01-15", payment_method="WALLET", status="FAILED")])
    shop.build(rules=ReportRules(window_days=30, payment_method="WALLET", denominator_statuses=["APPROVED", "FAILED"]))
    assert shop.performance(30)["2024-01-15", "M1"]["merchant_daily_approval_rate_30d"] == 0.5


def test_overwrite_replaces_only_the_partitions_it_has(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "v int, event_date string"
    overwrite_partitions(spark.createDataFrame([(1, "2024-01-15"), (2, "2024-01-16")], ddl), path, "event_date")
    overwrite_partitions(spark.createDataFrame([(3, "2024-01-16")], ddl), path, "event_date")
    overwrite_partitions(spark.createDataFrame([], ddl), path, "event_date")
    assert sorted((r["v"], r["event_date"]) for r in read_table(spark, path, ddl).collect()) == [
        (1, "2024-01-15"),
        (3, "2024-01-16"),
    ]


def month(start="2024-01-01", days=30):
    first = date.fromisoformat(start)
    return [dated(n, (first + timedelta(n)).isoformat()) for n in range(days)]


def test_backfill_equals_a_full_build(shop, spark):
    shop.load(month())
    shop.build()
    # One status changes, one payment is late, and one moves to another day outside the backfill.
    shop.load(
        [
            dated(14, "2024-01-15", status="REVERSED"),
            dated(100, "2024-01-15", amount="5"),
            dated(13, "2024-01-25"),
        ]
    )
    shop.build(dates=DateRange("2024-01-14", "2024-01-15"))
    backfilled = shop.performance()
    inside = {k: v for k, v in backfilled.items() if "2024-01-14" <= k[0] <= "2024-01-21"}
    assert backfilled["2024-01-15", "M1"]["total_transactions_7d"] == 7
    assert backfilled["2024-01-21", "M1"]["reversal_rate_7d"] == round(1 / 8, 4)
    shop.build()
    full = shop.performance()
    assert inside == {k: v for k, v in full.items() if "2024-01-14" <= k[0] <= "2024-01-21"}
    assert shop.daily()["2024-01-15", "M1", "REVERSED"] == 1


def test_a_damaged_file_fails_the_reports_or_is_set_aside(spark, shop):
    from pathlib import Path

    shop.load(month(days=20))
    shop.build()
    before_daily, before = shop.daily(), shop.performance()
    (cut,) = Path(shop.bronze).glob("event_date=2024-01-05/*.parquet")
    cut.write_bytes(cut.read_bytes()[: cut.stat().st_size // 2])
    with pytest.raises(Exception, match="parquet"):
        shop.build()
    assert (shop.daily(), shop.performance()) == (before_daily, before)
    result = shop.build(set_aside_damaged=True)
    assert result.status == "PARTIAL"
    assert [cut.name in r[0] for r in result.damaged.collect()] == [True]
    # Nothing that the lost rows belong to is overwritten, and nothing else changes.
    assert (shop.daily(), shop.performance()) == (before_daily, before)


def test_a_backfill_reads_the_days_that_hold_its_payments(spark, shop, capsys):
    from ledgerflow.plans.gold import backfill_payments
    from ledgerflow.sources.tables import read_bronze

    shop.load(month(days=20))
    backfill_payments(read_bronze(spark, shop.bronze), DateRange("2024-01-08", "2024-01-09")).explain("formatted")
    plan = capsys.readouterr().out
    assert "event_date" in next(line for line in plan.splitlines() if "PartitionFilters" in line and "2024-01-08" in line)


def test_pipeline_end_to_end(spark, tmp_path):
    write_csv(tmp_path / "in" / "1.csv", [dated(n, "2024-01-15") for n in range(3)])
    write_csv(tmp_path / "in" / "1b.csv", [dated(n, "2024-01-15") for n in range(4)])
    write_csv(tmp_path / "in" / "2.csv", [dated(10, "2024-01-16", merchant_id="M2")])
    merchants = str(write_merchants(tmp_path / "m.csv", [merchant("M1"), merchant("M2")]))
    lake = Lake(Landing(str(tmp_path / "in")), merchants, str(tmp_path / "out"))
    first = run_pipeline(spark, lake, run_id="run-1")
    written = {r["source_file"]: r["rows_written"] for r in first["payments"].counts.collect()}
    assert written == {"1.csv": 3, "1b.csv": 1, "2.csv": 1}
    again = run_pipeline(spark, lake)
    assert {r["rows_written"] for r in again["payments"].counts.collect()} == {0}
    assert again["reports"].tables == first["reports"].tables
    assert set(run_pipeline(spark, lake, "gold", rules=ReportRules(window_days=30))) == {"reports"}
    assert (tmp_path / "out/gold/merchant_performance_30d/snapshot_date=2024-01-15").is_dir()
    stages = {r["pipeline_stage"] for r in read_report(spark, lake.audit("run_report")).collect()}
    assert stages == {"bronze", "bronze_merchants", "gold"}
    with pytest.raises(ValueError, match="stage"):
        run_pipeline(spark, lake, "silver")


def test_views_answer_sql(spark, shop):
    shop.load([dated(1, "2024-01-15"), dated(2, "2024-01-15"), dated(3, "2024-01-16")])
    shop.build()
    register_views(
        spark, {"payments": shop.bronze, "daily": shop.daily_path, "performance": shop.performance_path}
    )
    rows = spark.sql("SELECT event_date, count(*) AS n FROM payments GROUP BY event_date ORDER BY event_date").collect()
    assert [(r["event_date"], r["n"]) for r in rows] == [("2024-01-15", 2), ("2024-01-16", 1)]
    assert spark.sql("SELECT * FROM daily WHERE event_date = '2024-01-15'").first()["transaction_count"] == 2
    assert spark.sql("SELECT max(snapshot_date) FROM performance").first()[0] == "2024-01-16"


def test_command_line(spark, tmp_path, capsys):
    write_csv(tmp_path / "in" / "1.csv", [dated(1, "2024-01-15"), dated(2, "2024-01-16")])
    merchants = str(write_merchants(tmp_path / "m.csv", [merchant("M1")]))
    base = ["--payments", str(tmp_path / "in"), "--merchants", merchants, "--root", str(tmp_path / "out")]
    assert main([*base, "--run-id", "run-1"]) == 0
    assert capsys.readouterr().out.splitlines() == [f"{n}: SUCCESS (run run-1)" for n in ("payments", "merchants", "reports")]
    assert main([*base, "--stage", "gold", "--from-date", "2024-01-16", "--to-date", "2024-01-16"]) == 0
    with pytest.raises(SystemExit):
        main([*base, "--from-date", "2024-01-16"])
