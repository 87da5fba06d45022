from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.dedup import new_rows
from ledgerflow.plans.bronze import ingest_payments
from ledgerflow.plans.gold import backfill_payments
from ledgerflow.sources import indexes
from ledgerflow.sources.buckets import Bucketed
from ledgerflow.sources.deliveries import Landing
from ledgerflow.sources.ledger import differing_files, listed_files, recorded_files, state_path, untrusted_days
from ledgerflow.sources.tables import read_bronze, read_hashes
from payments import payment, write_csv


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root, self.runs = spark, root, 0
        self.bronze = str(root / "bronze")

    def load(self, *rows, **options):
        self.runs += 1
        write_csv(self.root / f"in{self.runs}" / f"d{self.runs}.csv", rows)
        when = datetime(2024, 3, 1, tzinfo=timezone.utc) + timedelta(self.runs)
        return ingest_payments(self.spark, Landing(str(self.root / f"in{self.runs}")), self.bronze, ingest_ts=when, **options)

    def rows(self):
        return read_bronze(self.spark, self.bronze)

    def days(self):
        return [r[0] for r in self.rows().select("event_date").distinct().collect()]

    def files(self):
        return sorted((self.root / "bronze").rglob("*.parquet"))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def on(day, number, **values):
    return payment(f"T{number}", transaction_ts=f"2024-01-{day:02} 10:00:00", **values)


def hashes(frame):
    return sorted(bytes(r[0]) for r in frame.distinct().collect())


def plain_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_index_and_ledger_cover_what_was_ingested(lake):
    lake.load(*[on(1 + n % 4, n) for n in range(40)])
    lake.load(*[on(1 + n % 4, n) for n in range(20)], *[on(5, n) for n in range(20, 50)])
    found = indexes.stored_hashes(lake.spark, lake.bronze, lake.days())
    assert hashes(found) == sorted(bytes.fromhex(r[0]) for r in read_hashes(lake.spark, lake.bronze).distinct().collect())
    assert untrusted_days(lake.spark, lake.bronze) == []
    days = {tuple(r) for r in indexes.transaction_days(lake.spark, lake.bronze).collect()}
    assert days == {tuple(r) for r in lake.rows().select(F.xxhash64("transaction_id"), "event_date").collect()}
    ledger = recorded_files(lake.spark, lake.bronze)
    assert {(r["path"], r["bytes"]) for r in ledger.collect()} == {tuple(r) for r in listed_files(lake.spark, lake.bronze).collect()}
    assert ledger.agg(F.sum("rows")).first()[0] == lake.rows().count() == 70


def test_stored_hashes_are_joined_without_an_exchange(lake):
    lake.load(*[on(1 + n % 4, n) for n in range(40)])
    spark = lake.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    # Shows the buckets of a scan that no join needs.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        stored = indexes.stored_hashes(spark, lake.bronze, lake.days())
        assert "Exchange" not in plain_plan(stored.distinct())
        batch = spark.range(50).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("hash"))
        joined = plain_plan(batch.join(stored.distinct().withColumn("known", F.lit(True)), "hash", "left"))
        assert joined.count("Exchange") == 1 and joined.index("Exchange") < joined.index("Range") < joined.index("FileScan")
        held = indexes.transaction_days(spark, lake.bronze).filter(F.col("id_hash").isin([1, 2]))
        assert "SelectedBucketsCount" in plain_plan(held)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_run_that_broke_off_before_its_index_is_read_from_the_table(lake, monkeypatch):
    lake.load(on(1, 1), on(2, 2))

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr("ledgerflow.plans.bronze.index_rows", fail)
    with pytest.raises(RuntimeError, match="lost"):
        lake.load(on(2, 3), on(3, 4))
    monkeypatch.undo()
    assert untrusted_days(lake.spark, lake.bronze) == ["2024-01-02", "2024-01-03"]
    lake.load(on(1, 1), on(2, 2), on(2, 3), on(3, 4), on(3, 5))
    assert sorted(r[0] for r in lake.rows().select("transaction_id").collect()) == ["T1", "T2", "T3", "T4", "T5"]
    held = indexes.transaction_days(lake.spark, lake.bronze).filter(F.col("id_hash") == F.xxhash64(F.lit("T4")))
    assert {r["event_date"] for r in held.collect()} == {"2024-01-03"}


def test_rows_of_a_dropped_partition_can_be_ingested_again(lake):
    lake.load(on(1, 1), on(2, 2))
    for path in lake.files():
        if "2024-01-02" in str(path):
            path.unlink()
    lake.load(on(1, 1), on(2, 2))
    assert sorted(r[0] for r in lake.rows().select("transaction_id").collect()) == ["T1", "T2"]


def test_rows_written_by_others_are_known(lake):
    lake.load(on(1, 1))
    other = lake.rows().withColumn("record_hash", F.sha2(F.lit("x"), 256))
    other.write.mode("append").partitionBy("event_date").parquet(lake.bronze)
    assert bytes.fromhex(other.first()["record_hash"]) in hashes(indexes.stored_hashes(lake.spark, lake.bronze, ["2024-01-01"]))
    kinds = {r["found"] for r in differing_files(lake.spark, lake.bronze).collect()}
    assert kinds == {"new"}


def test_tables_without_a_ledger_work_and_can_be_indexed(lake, tmp_path):
    lake.load(on(1, 1), on(2, 2))
    plain = str(tmp_path / "plain")
    lake.rows().write.partitionBy("event_date").parquet(plain)
    assert indexes.transaction_days(lake.spark, plain) is None
    assert len(hashes(indexes.stored_hashes(lake.spark, plain, ["2024-01-01"]))) == 1
    indexes.rebuild_indexes(lake.spark, plain)
    assert untrusted_days(lake.spark, plain) == [] and indexes.transaction_days(lake.spark, plain).count() == 2
    with pytest.raises(ValueError, match="ledger already"):
        indexes.rebuild_indexes(lake.spark, plain)


@pytest.mark.parametrize("few", [0, 64])
def test_backfill_reads_the_days_the_index_names(lake, few, monkeypatch):
    monkeypatch.setattr(indexes.days_of, "__defaults__", (few,))
    lake.load(*[on(1 + n % 6, n, status="PENDING") for n in range(30)], on(3, 100), payment("", transaction_ts="2024-01-04 10:00:00"))
    lake.load(on(9, 2, status="APPROVED"), on(1, 100, status="REVERSED"))
    dates = DateRange("2024-01-03", "2024-01-04")
    index = indexes.transaction_days(lake.spark, lake.bronze)
    found, plain = (backfill_payments(lake.rows(), dates, i) for i in (index, None))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    touched = lake.rows().filter(dates.holds(F.col("event_date"))).select(F.xxhash64("transaction_id").alias("id_hash")).distinct()
    assert sorted(indexes.days_of(index, touched, few)) == ["2024-01-01", "2024-01-03", "2024-01-04", "2024-01-09"]


def test_buckets_keep_their_number_and_null_keys(spark, tmp_path):
    table = Bucketed(str(tmp_path / "it's"), "k bigint, v string", "k")
    assert table.read(spark) is None
    table.append(spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, v string"), 3)
    table.append(spark.createDataFrame([(2, "c")], "k bigint, v string"), 7)
    assert sorted(map(str, (r["v"] for r in table.read(spark).collect()))) == ["a", "b", "c"]
    assert table.folder(spark)[1] == 3


def test_a_hash_that_is_stored_loses_with_either_kind_of_hashes(spark):
    rows = spark.createDataFrame([("ab" * 32, "a.csv", 1), ("cd" * 32, "a.csv", 2)], "record_hash string, source_file string, v int")
    text = spark.createDataFrame([("ab" * 32,)], "record_hash string")
    for stored in (text, text.select(F.unhex("record_hash").alias("hash"))):
        assert [r["v"] for r in new_rows(rows, stored).collect()] == [2]


def test_state_lies_beside_the_table():
    assert state_path("s3a://lake/bronze/", "files") == "s3a://lake/bronze_state/files"
