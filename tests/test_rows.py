"""Contracts, lineage, hashes, fates and date ranges."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.hashing import record_hash
from ledgerflow.layout import METADATA_COLUMNS, PAYMENT_COLUMNS, PERSONAL_COLUMNS, performance_columns
from ledgerflow.operators.contracts import check_columns, check_rate_arguments, check_unique
from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.enrich import enrich
from ledgerflow.operators.quality import accepted, quarantined, row_fate
from ledgerflow.operators.typing import type_merchants, type_payments
from ledgerflow.plans.reports import REPORT_INPUT, current_payments
from payments import audit, lookup, merchant, payment


def text(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in PAYMENT_COLUMNS) for r in rows], [*PAYMENT_COLUMNS])


def test_contract_passes_and_reports_everything_missing():
    assert check_columns(PAYMENT_COLUMNS, PAYMENT_COLUMNS)
    check = check_columns(["currency"], ["status", "amount", "currency"], "a.csv")
    assert not check
    assert check.missing == ("amount", "status")
    assert check.message == "a.csv: missing columns: amount, status"


def test_contract_extra_columns_only_matter_when_strict():
    lenient = check_columns([*PAYMENT_COLUMNS, "payment_network"], PAYMENT_COLUMNS)
    assert lenient and lenient.message is None and lenient.unexpected == ("payment_network",)
    strict = check_columns([*PAYMENT_COLUMNS, "payment_network"], PAYMENT_COLUMNS, strict=True)
    assert not strict and "payment_network" in strict.message


def test_contract_is_case_sensitive():
    assert check_columns(["Amount"], ["amount"]).missing == ("amount",)


def test_rate_arguments():
    check_rate_arguments("CARD", ["APPROVED", "DECLINED"], "REVERSED")
    with pytest.raises(ValueError, match="status"):
        check_rate_arguments("CARD", ["APPROVED'; DROP TABLE x"])
    with pytest.raises(ValueError, match="status"):
        check_rate_arguments("CARD", [], "approved")
    with pytest.raises(ValueError, match="method"):
        check_rate_arguments("CASH", ["APPROVED"])


def test_repeated_merchant_is_refused(spark):
    check_unique(lookup(spark, ("M1", "a", "x"), ("M2", "b", "x")), "merchant_id", "lookup")
    with pytest.raises(ValueError, match="M1"):
        check_unique(lookup(spark, ("M1", "a", "x"), ("M1", "b", "x")), "merchant_id", "lookup")


def test_performance_column_names_carry_the_window():
    assert performance_columns(30)[-1] == "active_days_30d"
    assert len(performance_columns(7)) == 8


def test_enrich_adds_four_columns_and_leaves_the_input(spark):
    rows = text(spark, [payment()])
    before = rows.columns
    result = enrich(rows, "day.csv", "run-1", datetime(2024, 2, 1, tzinfo=timezone.utc))
    assert rows.columns == before
    assert set(result.columns) - set(before) == set(METADATA_COLUMNS)
    row = result.first()
    assert (row["ingest_run_id"], row["source_file"]) == ("run-1", "day.csv")
    assert row["ingest_ts"] is not None and len(row["record_hash"]) == 64
    assert enrich(rows, "day.csv").first()["ingest_run_id"]


def test_hash_depends_on_payload_only(spark):
    rows = text(spark, [payment()])
    one = enrich(rows, "a.csv", "run-1").first()["record_hash"]
    two = enrich(rows.select(*reversed(rows.columns)), "b.csv", "run-2").first()["record_hash"]
    other = enrich(text(spark, [payment(amount="100.01")]), "a.csv", "run-1").first()["record_hash"]
    assert one == two != other


def test_metadata_columns_of_the_input_are_replaced_and_not_hashed(spark):
    rows = text(spark, [payment()])
    brought = rows.withColumns({"source_file": F.lit("theirs"), "ingest_ts": F.lit("then")})
    row = enrich(brought, "ours.csv").first()
    assert row["source_file"] == "ours.csv"
    assert row["record_hash"] == enrich(rows, "x.csv").first()["record_hash"]


def test_hash_renders_types_canonically(spark):
    typed = type_payments(text(spark, [payment(amount="100", transaction_ts="2024-01-15 09:00:00.5")]))
    same = type_payments(text(spark, [payment(amount="1e2", transaction_ts="2024-01-15T09:00:00.500Z")]))
    digest = typed.select(record_hash(typed)).first()[0]
    assert digest == same.select(record_hash(same)).first()[0]
    values = payment() | {"amount": "100.00", "transaction_ts": "1705309200500000", "event_date": "2024-01-15"}
    canonical = "|".join(f"{c}={values[c]}" for c in sorted(values))
    assert digest == hashlib.sha256(canonical.encode()).hexdigest()


def test_hash_tells_null_from_blank_and_fractions_apart(spark):
    frame = spark.createDataFrame([(None, 1.0), ("", 1.0), ("", 1.001), ("", 1.0015)], "a string, b double")
    hashes = [r[0] for r in frame.select(record_hash(frame)).collect()]
    assert len(set(hashes)) == 4


def test_hash_tells_rows_apart_that_contain_separators(spark):
    rows = [("1", "2|b=3", ""), ("1|b=2", "3", ""), ("1", "2", "|b=3"), ("\\N", "", ""), (None, "", ""), ("\\", "|", "")]
    rows += [("\\|", "", ""), ("", "\\|", ""), ("1", "2\\|b=3", "")]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    assert len({r[0] for r in frame.select(record_hash(frame)).collect()}) == len(rows)


def test_hash_takes_any_column_name(spark):
    frame = spark.createDataFrame([("x", "y")], ["a.1", "b`c"])
    assert len(frame.select(record_hash(frame)).first()[0]) == 64


def test_fates(spark):
    rows = [
        payment("ok"),
        payment("amount", amount="N/A"),
        payment("time", transaction_ts="x"),
        payment("both", amount="", transaction_ts="x"),
        payment("other day", transaction_ts="2024-01-17 00:00:00"),
    ]
    typed = type_payments(text(spark, rows))
    everything = {r[0]: r[1] for r in typed.select("transaction_id", row_fate()).collect()}
    assert everything == {
        "ok": "accepted",
        "amount": "bad_amount",
        "time": "bad_timestamp",
        "both": "bad_amount",
        "other day": "accepted",
    }
    marked = typed.withColumn("fate", row_fate(DateRange("2024-01-15", "2024-01-16")))
    assert {r["transaction_id"]: r["fate"] for r in marked.collect()}["other day"] == "out_of_range"
    assert [r["transaction_id"] for r in accepted(marked).collect()] == ["ok"]
    assert {r["reason"] for r in quarantined(marked).collect()} == {"bad_amount", "bad_timestamp"}


def test_merchant_types(spark):
    rows = [merchant(), merchant("M2", onboarding_date="?", is_active=" False "), merchant("M3", is_active="maybe")]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))
    typed = {r["merchant_id"]: (str(r["onboarding_date"]), r["is_active"]) for r in type_merchants(frame).collect()}
    assert typed == {"M1": ("2022-03-15", True), "M2": ("None", False), "M3": ("2022-03-15", None)}


def test_date_ranges():
    assert DateRange("2024-02-28", "2024-03-01").days() == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert DateRange("2024-01-15", "2024-01-15").days() == ["2024-01-15"]
    wide = DateRange("2024-01-15", "2024-01-16").widened(before=6, after=6)
    assert (wide.first, wide.last) == ("2024-01-09", "2024-01-22")
    with pytest.raises(ValueError):
        DateRange("2024-01-16", "2024-01-15")
    with pytest.raises(ValueError):
        DateRange("yesterday", "today")


def test_reports_never_read_personal_data(spark):
    assert not set(REPORT_INPUT) & set(PERSONAL_COLUMNS)
    assert not set(current_payments(audit(spark, [payment()])).columns) & set(PERSONAL_COLUMNS)
