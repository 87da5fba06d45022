from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerflow.layout import DAILY_SUMMARY_DDL, performance_ddl
from ledgerflow.plans import gold, state
from ledgerflow.plans.bronze import ingest_payments
from ledgerflow.plans.gold import update_reports
from ledgerflow.plans.reports import ReportRules, current_payments, daily_report, performance_report
from ledgerflow.sources.deliveries import Landing
from ledgerflow.sources.tables import read_bronze, read_merchant_lookup
from ledgerflow.sources.versions import Publication
from payments import merchant, payment, write_csv, write_merchants

NAMES = {"daily_payment_summary": ("event_date", DAILY_SUMMARY_DDL), "merchant_performance_3d": ("snapshot_date", performance_ddl(3))}
RULES = ReportRules(window_days=3)


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root, self.runs = spark, root, 0
        self.bronze = str(root / "bronze")
        self.merchants = str(write_merchants(root / "merchants.csv", [merchant("M1"), merchant("M2")]))
        self.reports = Publication(str(root / "gold" / "published"), {n: str(root / "gold" / n) for n in NAMES})

    def load(self, *rows, **options):
        self.runs += 1
        write_csv(self.root / f"in{self.runs}" / f"d{self.runs}.csv", rows)
        when = datetime(2024, 3, 1, tzinfo=timezone.utc) + timedelta(self.runs)
        return ingest_payments(self.spark, Landing(str(self.root / f"in{self.runs}")), self.bronze, ingest_ts=when, **options)

    def audit(self):
        return read_bronze(self.spark, self.bronze)

    def refresh(self):
        return state.refresh_current(self.spark, self.bronze, f"run{self.runs}")

    def update(self, **options):
        return update_reports(self.spark, self.bronze, self.merchants, self.reports, rules=RULES, **options)

    def published(self, number=None):
        return {n: rows(self.reports.read(self.spark, n, ddl, p, number)) for n, (p, ddl) in NAMES.items()}

    def rebuilt(self):
        lookup = read_merchant_lookup(self.spark, self.merchants)
        return {
            "daily_payment_summary": rows(daily_report(self.audit(), lookup, RULES)),
            "merchant_performance_3d": rows(performance_report(self.audit(), lookup, RULES)),
        }

    def same_as_rebuilt(self):
        current = rows(state.current_state(self.spark, self.bronze))
        again = rows(current_payments(self.audit()).withColumn("event_date", F.col("event_date").cast("string")))
        assert current == again


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def rows(frame):
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=str)


def on(day, number, **values):
    return payment(f"T{number}", transaction_ts=f"2024-01-{day:02} 10:00:00", **values)


def test_merges_equal_a_rebuild_after_late_versions_moves_and_resubmissions(lake):
    rng = random.Random(6)
    first = [on(1 + n % 9, n, merchant_id=f"M{n % 3}", amount=str(n)) for n in range(60)]
    lake.load(*first)
    assert lake.refresh().rebuilt
    lake.same_as_rebuilt()
    # Later versions of the same day, of other days, new ids, and a resubmission.
    for _ in range(3):
        late = [on(rng.randint(1, 9), rng.randrange(80), status=rng.choice(["DECLINED", "REVERSED"])) for _ in range(9)]
        lake.load(*late, *first[:10])
        refreshed = lake.refresh()
        assert not refreshed.rebuilt and refreshed.days
        lake.same_as_rebuilt()
    assert lake.refresh() == state.Refreshed([], False)


def test_a_merge_rewrites_touched_days_alone(lake):
    lake.load(*[on(1 + n % 9, n) for n in range(40)])
    lake.refresh()
    before = state.publication(lake.bronze).state(lake.spark)["current"]
    lake.load(on(4, 0, status="REVERSED"))
    assert lake.refresh().days == ["2024-01-01", "2024-01-04"]
    after = state.publication(lake.bronze).state(lake.spark)["current"]
    assert {d for d in before if before[d] != after[d]} == {"2024-01-01", "2024-01-04"}
    lake.same_as_rebuilt()


def test_a_day_whose_last_payment_moved_away_is_empty(lake):
    lake.load(on(1, 1), on(2, 2))
    lake.update()
    lake.load(on(5, 2))
    lake.update()
    assert sorted(state.publication(lake.bronze).state(lake.spark)["current"]) == ["2024-01-01", "2024-01-05"]
    assert lake.published() == lake.rebuilt()


def test_lost_and_changed_files_rebuild(lake):
    lake.load(on(1, 1), on(2, 2))
    lake.refresh()
    next(p for p in (lake.root / "bronze").rglob("*.parquet") if "2024-01-02" in str(p)).unlink()
    lake.load(on(3, 3))
    assert lake.refresh().rebuilt
    lake.same_as_rebuilt()


def test_tables_without_an_index_are_merged_as_well(lake, tmp_path):
    lake.load(on(1, 1), on(2, 2), on(3, 3))
    plain = Lake(lake.spark, tmp_path / "other")
    lake.audit().write.partitionBy("event_date").parquet(plain.bronze)
    plain.refresh()
    later = lake.audit().filter("transaction_id = 'T1'").withColumn("ingest_ts", F.lit(datetime(2025, 1, 1)))
    later.withColumn("event_date", F.lit("2024-01-03")).write.mode("append").partitionBy("event_date").parquet(plain.bronze)
    assert plain.refresh().days == ["2024-01-01", "2024-01-03"]
    plain.same_as_rebuilt()


def test_updated_reports_equal_a_rebuild(lake):
    rng = random.Random(3)
    lake.load(*[on(1 + n % 12, n, merchant_id=f"M{n % 4}", amount=f"{n}.25") for n in range(70)])
    assert lake.update().status == "SUCCESS"
    assert lake.published() == lake.rebuilt()
    for _ in range(2):
        lake.load(*[on(rng.randint(5, 7), rng.randrange(90), status="REVERSED", merchant_id=f"M{rng.randrange(4)}") for _ in range(5)])
        lake.update()
        assert lake.published() == lake.rebuilt()
    result = lake.update()
    assert result.tables["daily_payment_summary"] == {"rows_read": 0, "rows_written": 0}
    assert lake.published() == lake.rebuilt()


def test_both_reports_appear_together_or_not_at_all(lake, monkeypatch):
    lake.load(on(1, 1), on(2, 2))
    lake.update()
    before = lake.published()
    lake.load(on(2, 2, status="REVERSED"), on(3, 3))
    write = Publication.write

    def broken(self, df, table, *args):
        if table.startswith("merchant_performance"):
            raise RuntimeError("lost")
        return write(self, df, table, *args)

    monkeypatch.setattr(Publication, "write", broken)
    with pytest.raises(RuntimeError, match="lost"):
        lake.update()
    assert lake.published() == before
    monkeypatch.undo()
    # The state went on; the reports catch up with all it has changed since.
    lake.update()
    assert lake.published() == lake.rebuilt() != before


def test_old_versions_stay_readable_until_they_are_dropped(lake):
    lake.load(on(1, 1), on(2, 2))
    lake.update()
    before = lake.published()
    lake.load(on(2, 2, status="REVERSED"))
    lake.update()
    assert lake.published(1) == before != lake.published()
    after = lake.published()
    lake.reports.drop_old(lake.spark)
    assert lake.reports.numbers(lake.spark) == [2] and lake.published() == after
    kept = {p.name for n in NAMES for p in (lake.root / "gold" / n).glob("version=*")}
    used = {f"version={v}" for n in NAMES for v in lake.reports.state(lake.spark)[n].values()}
    assert kept == used


def test_two_writers_are_told_apart(spark, tmp_path, monkeypatch):
    tables = Publication(str(tmp_path / "p"), {"t": str(tmp_path / "t")})
    frame = spark.createDataFrame([(1,)], "v int")
    assert tables.read(spark, "t", "v int").count() == 0
    tables.publish(spark, {"t": tables.write(frame, "t", "a")})
    monkeypatch.setattr(Publication, "numbers", lambda self, spark: [])
    with pytest.raises(RuntimeError, match="somebody else"):
        tables.publish(spark, {"t": tables.write(frame, "t", "b")})


def test_published_views(lake):
    lake.load(on(1, 1))
    lake.update()
    lake.reports.register_views(lake.spark, {n: ddl for n, (_, ddl) in NAMES.items()}, {n: p for n, (p, _) in NAMES.items()})
    assert lake.spark.sql("SELECT event_date, transaction_count FROM daily_payment_summary").collect() == [("2024-01-01", 1)]


def test_no_payments_at_all(lake):
    result = lake.update(report_path=str(lake.root / "report"))
    assert result.status == gold.FAILED and lake.reports.numbers(lake.spark) == []
