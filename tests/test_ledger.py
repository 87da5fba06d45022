from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerflow.layout import PAYMENT_COLUMNS
from ledgerflow.plans.bronze import ingest_payments
from ledgerflow.plans.gold import build_reports
from ledgerflow.sources import ledger
from ledgerflow.sources.columns import log_columns, logged_columns, logged_schema, read_evolved
from ledgerflow.sources.deliveries import Landing
from ledgerflow.sources.tables import read_bronze, read_table
from payments import merchant, payment, write_csv, write_merchants


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root, self.runs = spark, root, 0
        self.bronze = str(root / "bronze")
        self.merchants = str(write_merchants(root / "merchants.csv", [merchant("M1")]))

    def load(self, *rows, columns=PAYMENT_COLUMNS):
        self.runs += 1
        write_csv(self.root / f"in{self.runs}" / f"d{self.runs}.csv", rows, columns)
        return ingest_payments(self.spark, Landing(str(self.root / f"in{self.runs}")), self.bronze)

    def file_of(self, day):
        return next(p for p in (self.root / "bronze").rglob("*.parquet") if f"2024-01-{day:02}" in str(p))

    def build(self, **options):
        return build_reports(
            self.spark, self.bronze, self.merchants, str(self.root / "daily"), str(self.root / "perf"), set_aside_damaged=True, **options
        )

    def days(self):
        found = read_table(self.spark, str(self.root / "daily"), "event_date string")
        return sorted(r[0] for r in found.distinct().collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def on(day, number, **values):
    return payment(f"T{number}", transaction_ts=f"2024-01-{day:02} 10:00:00", **values)


def paths(frame):
    return [r["path"] for r in frame.collect()]


def test_shorter_and_lost_files_are_found_without_opening_any(lake):
    lake.load(*[on(1 + n % 3, n) for n in range(30)])
    lake.load(on(1, 50))
    assert paths(ledger.damaged_by_listing(lake.spark, lake.bronze)) == []
    short = lake.file_of(2)
    short.write_bytes(short.read_bytes()[:-10])
    lake.file_of(1).unlink()
    lake.file_of(3).unlink()
    found = paths(ledger.damaged_by_listing(lake.spark, lake.bronze))
    # Day 3 has no file left: a partition may be dropped on purpose.
    assert len(found) == 2 and {p.split("/")[0] for p in found} == {"event_date=2024-01-01", "event_date=2024-01-02"}


def test_reports_go_without_the_days_of_damaged_files(lake):
    lake.load(*[on(1 + n % 3, n) for n in range(30)])
    path = lake.file_of(2)
    path.write_bytes(b"PAR1" + b"x" * (path.stat().st_size - 8) + b"PAR1")
    result = lake.build()
    assert result.status == "PARTIAL" and lake.days() == ["2024-01-01", "2024-01-03"]
    assert [r[0].split("/")[0] for r in result.damaged.collect()] == ["event_date=2024-01-02"]


def test_sound_tables_are_read_once(lake, monkeypatch):
    lake.load(*[on(1 + n % 3, n) for n in range(30)])

    def never(*_):
        raise AssertionError("no file is looked for")

    monkeypatch.setattr("ledgerflow.plans.gold.damaged_by_content", never)
    result = lake.build()
    assert result.status == "SUCCESS" and result.damaged is None and len(lake.days()) == 3


def test_rows_are_held_against_the_recorded_checksum(lake):
    lake.load(*[on(1, n) for n in range(20)])
    path = lake.file_of(1)
    rows, total = ledger.expected_shape(lake.spark, lake.bronze)
    seen = read_bronze(lake.spark, lake.bronze).agg(F.count(F.lit(1)), ledger.checksum()).first()
    assert (rows, total) == (seen[0], int(seen[1])) and rows == 20
    # Other rows under the same name.
    other = lake.spark.read.parquet(str(path)).withColumn("record_hash", F.sha2("record_hash", 256))
    other.coalesce(1).write.parquet(str(lake.root / "other"))
    path.write_bytes(next((lake.root / "other").glob("*.parquet")).read_bytes())
    assert paths(ledger.damaged_by_content(lake.spark, lake.bronze)) == [str(path.relative_to(lake.root / "bronze"))]


def test_columns_are_logged_and_no_footer_is_asked(lake):
    lake.load(on(1, 1))
    lake.load(on(2, 2, device="d1"), columns=[*PAYMENT_COLUMNS, "device"])
    names = [n for n, _ in logged_columns(lake.spark, lake.bronze)]
    assert set(names) == set(lake.spark.read.option("mergeSchema", True).parquet(lake.bronze).columns)
    assert logged_schema(lake.spark, lake.bronze) is not None
    rows = {r["transaction_id"]: (r["device"], r["event_date"]) for r in read_evolved(lake.spark, lake.bronze).collect()}
    assert rows == {"T1": (None, "2024-01-01"), "T2": ("d1", "2024-01-02")}


def test_files_of_others_are_asked_for_their_columns(lake):
    lake.load(on(1, 1))
    other = read_bronze(lake.spark, lake.bronze).withColumn("fee", F.lit(1.5))
    other.write.mode("append").partitionBy("event_date").parquet(lake.bronze)
    assert logged_schema(lake.spark, lake.bronze) is None
    assert "fee" in read_evolved(lake.spark, lake.bronze).columns


def test_a_column_keeps_its_type(spark, tmp_path):
    table = str(tmp_path / "t")
    fields = spark.createDataFrame([], "a int, `b, c` string").schema.fields
    log_columns(spark, table, fields, "r1")
    log_columns(spark, table, fields, "r2")
    assert logged_columns(spark, table) == [("a", "int"), ("b, c", "string")]
    with pytest.raises(ValueError, match="type"):
        log_columns(spark, table, spark.createDataFrame([], "a string").schema.fields, "r3")
