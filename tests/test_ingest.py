from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerflow.layout import PAYMENT_COLUMNS
from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.dedup import drop_stored, new_rows
from ledgerflow.plans.audit import read_manifest, read_report
from ledgerflow.plans.bronze import ingest_merchants, ingest_payments
from ledgerflow.sources.deliveries import Landing
from ledgerflow.sources.columns import read_evolved
from ledgerflow.sources.tables import read_bronze, read_bronze_merchants, read_hashes
from payments import merchant, payment, write_csv, write_merchants

COUNTS = ["rows_read", "rows_written", "rows_skipped", "rows_quarantined", "rows_undated", "rows_out_of_range"]


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.landing = Landing(str(root / "in"))
        self.bronze = str(root / "bronze")

    def deliver(self, name, rows, columns=PAYMENT_COLUMNS):
        write_csv(self.root / "in" / name, rows, columns)

    def ingest(self, **options):
        return ingest_payments(self.spark, self.landing, self.bronze, **options)

    def stored(self):
        return read_bronze(self.spark, self.bronze)

    def ids(self):
        return sorted(r[0] for r in self.stored().select("transaction_id").collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def counts(result):
    return {r["source_file"]: tuple(r[c] for c in COUNTS) for r in result.counts.collect()}


def outcomes(result):
    return {r["source_file"]: r["outcome"] for r in result.counts.collect()}


def test_double_run_adds_nothing(lake):
    lake.deliver("a.csv", [payment("T1"), payment("T2"), payment("T3")])
    first, second = lake.ingest(), lake.ingest()
    assert first.status == second.status == "SUCCESS" and first.run_id != second.run_id
    assert counts(first) == {"a.csv": (3, 3, 0, 0, 0, 0)}
    assert counts(second) == {"a.csv": (3, 0, 3, 0, 0, 0)}
    assert lake.stored().count() == 3


def test_resubmission_adds_only_new_rows(lake):
    lake.deliver("a.csv", [payment("T1"), payment("T2")])
    lake.ingest()
    lake.deliver("a_resubmit.csv", [payment("T1"), payment("T2"), payment("T3"), payment("T4")])
    assert counts(lake.ingest())["a_resubmit.csv"] == (4, 2, 2, 0, 0, 0)
    assert lake.ids() == ["T1", "T2", "T3", "T4"]


def test_one_run_equals_loading_in_name_order(lake):
    lake.deliver("2.csv", [payment("T1"), payment("T2"), payment("T2")])
    lake.deliver("1.csv", [payment("T1"), payment("T1")])
    assert counts(lake.ingest()) == {"1.csv": (2, 2, 0, 0, 0, 0), "2.csv": (3, 2, 1, 0, 0, 0)}
    assert lake.ids() == ["T1", "T1", "T2", "T2"]


def test_strict_unique_stores_one_copy(lake):
    lake.deliver("1.csv", [payment("T1"), payment("T1")])
    lake.ingest(strict_unique=True)
    assert lake.ids() == ["T1"]


def test_status_change_is_a_new_row(lake):
    lake.deliver("1.csv", [payment("T1", status="PENDING")])
    lake.deliver("2.csv", [payment("T1", status="APPROVED")])
    lake.ingest()
    assert lake.ids() == ["T1", "T1"]


def test_stored_rows_are_typed_and_traced(lake):
    lake.deliver("a.csv", [payment("T1", card_last4="")])
    lake.ingest(run_id="run-1", ingest_ts=datetime(2024, 2, 1, tzinfo=timezone.utc))
    (row,) = lake.stored().collect()
    assert (row["amount"], row["card_last4"], row["event_date"]) == (100.0, "", "2024-01-15")
    assert (row["ingest_run_id"], row["source_file"], len(row["record_hash"])) == ("run-1", "a.csv", 64)
    assert row["customer_email"] == "c1@mail.test"


def test_delivery_without_a_required_column_is_left_out(lake):
    lake.deliver("bad.csv", [payment("T1")], [c for c in PAYMENT_COLUMNS if c != "amount"])
    lake.deliver("good.csv", [payment("T2"), payment("T3")])
    result = lake.ingest()
    assert result.status == "PARTIAL" and lake.ids() == ["T2", "T3"]
    assert outcomes(result) == {"bad.csv": "missing_columns", "good.csv": "ingested"}
    assert counts(result)["bad.csv"] == (1, 0, 1, 0, 0, 0)


def test_only_bad_deliveries(lake):
    lake.deliver("bad.csv", [payment("T1")], ["transaction_id"])
    assert lake.ingest().status == "PARTIAL"
    assert lake.stored().count() == 0


def test_overflowing_and_empty_deliveries_are_left_out(lake):
    lake.deliver("good.csv", [payment("T1")])
    lake.deliver("none.csv", [])
    header = ",".join(PAYMENT_COLUMNS)
    (lake.root / "in" / "long.csv").write_text(f"{header}\n{','.join(payment('T2').values())},more\n")
    (lake.root / "in" / "void.csv").touch()
    result = lake.ingest()
    assert outcomes(result) == {"good.csv": "ingested", "none.csv": "ingested", "long.csv": "overflowing", "void.csv": "empty"}
    assert counts(result)["none.csv"] == (0,) * 6 and counts(result)["long.csv"] == (1, 0, 1, 0, 0, 0)
    assert result.status == "PARTIAL" and lake.ids() == ["T1"]


def test_no_deliveries(lake):
    result = lake.ingest()
    assert result.status == "SUCCESS" and result.counts is None


def test_runs_without_rows_are_in_the_manifest(spark, lake):
    manifest = str(lake.root / "manifest")
    lake.ingest(run_id="nothing", manifest_path=manifest)
    (lake.root / "in").mkdir()
    (lake.root / "in" / "void.csv").touch()
    assert lake.ingest(run_id="void", manifest_path=manifest).status == "PARTIAL"
    rows = {r["run_id"]: (r["source_file"], r["outcome"], r["status"], r["rows_read"]) for r in read_manifest(spark, manifest).collect()}
    assert rows == {"nothing": (None, None, "SUCCESS", 0), "void": ("void.csv", "empty", "PARTIAL", 0)}


def test_a_run_leaves_no_personal_data_behind(spark, lake):
    from ledgerflow.session import shared_folder

    def left():
        from pathlib import Path

        return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).glob("ledgerflow/*")}

    before = left()
    lake.deliver("a.csv", [payment("T1"), payment("T2", amount="?")])
    lake.ingest(quarantine_path=str(lake.root / "aside"))
    assert all(name.startswith("delivery-counts") for name in left() - before)
    (lake.root / "in" / "b.csv").write_text(",".join(reversed(PAYMENT_COLUMNS)) + "\n")
    before = left()
    with pytest.raises(ValueError, match="CSV header"):
        lake.ingest(columns=PAYMENT_COLUMNS)
    assert left() == before


def test_quarantined_rows_are_stored_once(spark, lake):
    aside = str(lake.root / "aside")
    lake.deliver("a.csv", [payment("T1", amount="?"), payment("T2", transaction_ts="x"), payment("T1", amount="!")])
    for _ in range(2):
        assert counts(lake.ingest(quarantine_path=aside)) == {"a.csv": (3, 0, 0, 2, 1, 0)}
    lake.deliver("b.csv", [payment("T1", amount="?"), payment("T3", amount="?")])
    lake.ingest(quarantine_path=aside)
    rows = sorted((r["transaction_id"], r["rejected_text"], r["source_file"]) for r in spark.read.parquet(aside).collect())
    assert rows == [("T1", "!", "a.csv"), ("T1", "?", "a.csv"), ("T2", "x", "a.csv"), ("T3", "?", "b.csv")]


def test_columns_named_like_helpers_are_stored(spark, lake):
    columns = [*PAYMENT_COLUMNS, "fate", "reason"]
    lake.deliver("a.csv", [payment("T1", fate="f", reason="r")], columns)
    lake.ingest()
    (row,) = read_evolved(spark, lake.bronze).collect()
    assert (row["fate"], row["reason"]) == ("f", "r")
    lake.deliver("b.csv", [payment("T2", fate="f", reason="r", amount="?")], columns)
    with pytest.raises(ValueError, match="reason"):
        lake.ingest(quarantine_path=str(lake.root / "aside"))


def test_columns_can_be_left_out_of_the_hash(lake):
    lake.deliver("a.csv", [payment("T1", gateway_ref="G1")])
    lake.ingest(hash_exclude=["gateway_ref"])
    lake.deliver("b.csv", [payment("T1", gateway_ref="G2")])
    assert counts(lake.ingest(hash_exclude=["gateway_ref"]))["b.csv"] == (1, 0, 1, 0, 0, 0)
    assert counts(lake.ingest())["b.csv"] == (1, 1, 0, 0, 0, 0)


def test_bad_values_are_set_aside(spark, lake):
    lake.deliver("a.csv", [payment(f"A{n}", amount=a) for n, a in enumerate(["N/A", "", "1,000", "nan", "7"])])
    lake.deliver("b.csv", [payment("B0", transaction_ts="x"), payment("B1")])
    aside = str(lake.root / "aside")
    result = lake.ingest(quarantine_path=aside)
    assert counts(result) == {"a.csv": (5, 1, 0, 4, 0, 0), "b.csv": (2, 1, 0, 0, 1, 0)}
    assert result.status == "PARTIAL" and lake.ids() == ["A4", "B1"]
    rows = {r["transaction_id"]: (r["reason"], r["rejected_text"]) for r in spark.read.parquet(aside).collect()}
    assert rows["A2"] == ("bad_amount", "1,000") and rows["B0"] == ("bad_timestamp", "x") and len(rows) == 5
    assert {p.name for p in (lake.root / "bronze").glob("event_date=*")} == {"event_date=2024-01-15"}


def test_backfill_appends_its_dates_only(lake):
    days = ("2024-01-14", "2024-01-15", "2024-01-16")
    lake.deliver("a.csv", [payment(d, transaction_ts=f"{d} 09:00:00") for d in days] + [payment("bad", amount="")])
    result = lake.ingest(dates=DateRange("2024-01-15", "2024-01-16"))
    assert counts(result) == {"a.csv": (4, 2, 0, 1, 0, 1)}
    assert lake.ids() == ["2024-01-15", "2024-01-16"]
    assert counts(lake.ingest()) == {"a.csv": (4, 1, 2, 1, 0, 0)}


def test_new_column_in_a_later_delivery(spark, lake):
    lake.deliver("1.csv", [payment("T1")])
    lake.ingest()
    lake.deliver("2.csv", [payment("T2", payment_network="VISA")], [*PAYMENT_COLUMNS, "payment_network"])
    result = lake.ingest()
    # The older delivery keeps its hashes although the batch has one column more.
    assert counts(result) == {"1.csv": (1, 0, 1, 0, 0, 0), "2.csv": (1, 1, 0, 0, 0, 0)}
    expected = {"T1": None, "T2": "VISA"}
    for table in (read_evolved(spark, lake.bronze), read_bronze(spark, lake.bronze, extra_columns=["payment_network"])):
        assert {r["transaction_id"]: r["payment_network"] for r in table.collect()} == expected
    assert "payment_network" not in lake.stored().columns


def test_many_dates_are_written_together(lake):
    rows = [payment(f"T{n}", transaction_ts=f"2024-01-{n % 28 + 1:02d} 09:00:00") for n in range(140)]
    lake.deliver("a.csv", rows)
    lake.ingest()
    assert lake.stored().count() == 140
    assert len(list((lake.root / "bronze").glob("event_date=*/*.parquet"))) == 28


def test_hot_record_keeps_all_its_copies(lake):
    rows = [payment("hot")] * 300 + [payment(f"T{n}") for n in range(600)]
    lake.deliver("a.csv", rows)
    lake.deliver("b.csv", rows)
    assert counts(lake.ingest()) == {"a.csv": (900, 900, 0, 0, 0, 0), "b.csv": (900, 0, 900, 0, 0, 0)}


def test_manifest_and_report(spark, lake):
    lake.deliver("bad.csv", [payment("T1")], ["transaction_id"])
    lake.deliver("good.csv", [payment("T2"), payment("T3", amount="?")])
    manifest, report = str(lake.root / "manifest"), str(lake.root / "report")
    lake.ingest(run_id="run-1", manifest_path=manifest, report_path=report, extra={"operator": "night shift"})
    lake.ingest(run_id="run-2", manifest_path=manifest, report_path=report)
    rows = {(r["run_id"], r["source_file"]): r for r in read_manifest(spark, manifest).collect()}
    assert len(rows) == 4 and {r["status"] for r in rows.values()} == {"PARTIAL"}
    assert rows["run-1", "good.csv"]["rows_written"] == 1 and rows["run-2", "good.csv"]["rows_skipped"] == 1
    assert rows["run-1", "bad.csv"]["missing_columns"].startswith("amount,card_last4")
    assert rows["run-1", "bad.csv"]["run_ts"] is not None
    assert rows["run-1", "bad.csv"]["extra"] == {"operator": "night shift"}
    assert not rows["run-2", "bad.csv"]["extra"]
    measures = {(r["run_id"], r["table_name"]): r for r in read_report(spark, report).collect()}
    first = measures["run-1", "good.csv"]
    assert (first["rows_read"], first["rows_written"], first["rows_quarantined"]) == (2, 1, 1)
    assert measures["run-1", "bad.csv"]["rows_quarantined"] == 1
    assert first["status"] == "PARTIAL" and first["pipeline_stage"] == "bronze" and first["duration_seconds"] > 0


def test_failed_run_is_reported(spark, lake):
    lake.deliver("a.csv", [payment("T1")])
    lake.deliver("b.csv", [payment("T1")], list(reversed(PAYMENT_COLUMNS)))
    report = str(lake.root / "report")
    with pytest.raises(Exception, match="CSV header"):
        lake.ingest(run_id="run-1", columns=PAYMENT_COLUMNS, report_path=report)
    (row,) = read_report(spark, report).collect()
    assert (row["status"], row["table_name"], row["rows_read"]) == ("FAILED", None, 0)


def test_promised_header_loads_the_same(lake):
    lake.deliver("a.csv", [payment("T1"), payment("T2", amount="")])
    assert counts(lake.ingest(columns=PAYMENT_COLUMNS)) == {"a.csv": (2, 1, 0, 1, 0, 0)}


def test_merchants_keep_versions(spark, tmp_path):
    table = str(tmp_path / "merchants")

    def load(*rows):
        path = write_merchants(tmp_path / "merchants.csv", rows)
        return ingest_merchants(spark, str(path), table)

    assert counts(load(merchant("M1"), merchant("M2")))["merchants.csv"][:3] == (2, 2, 0)
    assert counts(load(merchant("M1"), merchant("M2")))["merchants.csv"][:3] == (2, 0, 2)
    assert counts(load(merchant("M1", is_active="false"), merchant("M2")))["merchants.csv"][:3] == (2, 1, 1)
    versions = read_bronze_merchants(spark, table)
    assert versions.count() == 3 and versions.schema["onboarding_date"].dataType.typeName() == "date"
    assert {(r["merchant_id"], r["is_active"]) for r in versions.collect()} == {("M1", True), ("M1", False), ("M2", True)}


def test_merchant_failures(spark, tmp_path):
    report = str(tmp_path / "report")
    missing = ingest_merchants(spark, str(tmp_path / "none.csv"), str(tmp_path / "m"), run_id="1", report_path=report)
    path = write_csv(tmp_path / "bad.csv", [merchant()], ["merchant_id", "merchant_name"])
    refused = ingest_merchants(spark, str(path), str(tmp_path / "m"), run_id="2", report_path=report)
    assert missing.status == refused.status == "FAILED"
    rows = {r["run_id"]: (r["status"], r["rows_read"], r["rows_quarantined"]) for r in read_report(spark, report).collect()}
    assert rows == {"1": ("FAILED", 0, 0), "2": ("PARTIAL", 1, 1)}


def test_damaged_files(spark, lake):
    lake.deliver("a.csv", [payment("T1")])
    lake.ingest()
    (lake.root / "bronze" / "event_date=2024-01-15" / "part-damaged.parquet").write_bytes(b"PAR1 not a table PAR1")
    # Only a read that asks for it does without what is damaged; the duplicate check never does.
    assert read_bronze(spark, lake.bronze, columns=["transaction_id"], skip_corrupt=True).collect()[0][0] == "T1"
    with pytest.raises(Exception, match="part-damaged"):
        read_bronze(spark, lake.bronze, columns=["transaction_id"]).collect()
    with pytest.raises(Exception, match="part-damaged"):
        read_hashes(spark, lake.bronze, ["2024-01-15"]).collect()


def test_unchanged_files_can_be_left_out(lake):
    lake.deliver("old.csv", [payment("T1")])
    lake.landing = Landing(str(lake.root / "in"), modified_after="2100-01-01T00:00:00")
    assert lake.ingest().counts is None
    lake.landing = Landing(str(lake.root / "in"), modified_after="2000-01-01T00:00:00")
    assert counts(lake.ingest()) == {"old.csv": (1, 1, 0, 0, 0, 0)}


@pytest.mark.parametrize("days", [1, 9])
def test_large_batches_take_the_shuffle_and_store_the_same(spark, lake, monkeypatch, days):
    monkeypatch.setattr("ledgerflow.operators.joins.fits_broadcast", lambda *a: False)
    rows = [payment(f"T{n}", transaction_ts=f"2024-01-{n % days + 1:02d} 09:00:00") for n in range(90)]
    lake.deliver("a.csv", rows + rows[:1] * 50)
    lake.deliver("b.csv", rows + [payment("new")])
    assert counts(lake.ingest()) == {"a.csv": (140, 140, 0, 0, 0, 0), "b.csv": (91, 1, 90, 0, 0, 0)}
    assert counts(lake.ingest()) == {"a.csv": (140, 0, 140, 0, 0, 0), "b.csv": (91, 0, 91, 0, 0, 0)}
    assert lake.stored().count() == 141


def test_hot_record_is_split_among_tasks(spark, capsys, monkeypatch):
    monkeypatch.setattr("ledgerflow.operators.joins.fits_broadcast", lambda *a: False)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        # Copies of one hash compress well, so a small test needs a low factor.
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.01",
    }
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    batch = spark.range(0, 60_000, 1, 8).select(
        F.sha2(hot.cast("string"), 256).alias("record_hash"), F.lit("a.csv").alias("source_file"), F.uuid().alias("y")
    )
    # Some records are known, so that an anti join is needed at all.
    stored = batch.filter("y < '1'").filter(F.col("record_hash") != F.sha2(F.lit("0"), 256))
    stored = stored.unionByName(batch.limit(1).withColumn("record_hash", F.sha2(F.lit("-1"), 256)))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for kept in (new_rows(batch, stored), drop_stored(batch, stored)):
            counted = kept.groupBy(F.substring("y", 1, 1)).count()
            assert 20_000 < sum(r["count"] for r in counted.collect()) <= 60_000
            counted.explain()
            assert "(skew=true)" in capsys.readouterr().out
    finally:
        for name in settings:
            spark.conf.unset(name)
