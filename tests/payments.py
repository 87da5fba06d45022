"""Builders for small payment deliveries and audit rows."""

from __future__ import annotations

import csv
from datetime import datetime, timezone
from pathlib import Path

from ledgerflow.layout import MERCHANT_COLUMNS, PAYMENT_COLUMNS

AUDIT_DDL = (
    "transaction_id string, merchant_id string, customer_id string, customer_email string, customer_phone string, "
    "amount double, currency string, status string, transaction_ts timestamp, payment_method string, "
    "card_last4 string, gateway_ref string, event_date string, ingest_ts timestamp"
)


def payment(transaction_id="T1", **values) -> dict[str, str]:
    """One delivery row."""
    row = {
        "transaction_id": transaction_id,
        "merchant_id": "M1",
        "customer_id": "C1",
        "customer_email": "c1@mail.test",
        "customer_phone": "+15550001",
        "amount": "100.00",
        "currency": "USD",
        "status": "APPROVED",
        "transaction_ts": "2024-01-15 09:00:00",
        "payment_method": "CARD",
        "card_last4": "1234",
        "gateway_ref": "G1",
    }
    return row | values


def write_csv(path: Path, rows, columns=PAYMENT_COLUMNS) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as target:
        writer = csv.DictWriter(target, columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
    return path


def merchant(merchant_id="M1", **values) -> dict[str, str]:
    row = {
        "merchant_id": merchant_id,
        "merchant_name": f"Shop {merchant_id}",
        "merchant_category": "RETAIL",
        "country": "GB",
        "onboarding_date": "2022-03-15",
        "is_active": "true",
        "settlement_currency": "GBP",
    }
    return row | values


def write_merchants(path: Path, rows) -> Path:
    return write_csv(path, rows, MERCHANT_COLUMNS)


def audit(spark, rows):
    """Typed audit rows from delivery rows, as after ingest."""
    data = []
    for row in rows:
        when = datetime.fromisoformat(row["transaction_ts"]).replace(tzinfo=timezone.utc)
        amount = row["amount"]
        data.append(
            tuple(row[c] for c in PAYMENT_COLUMNS[:5])
            + (None if amount is None else float(amount),)
            + tuple(row[c] for c in PAYMENT_COLUMNS[6:8])
            + (when,)
            + tuple(row[c] for c in PAYMENT_COLUMNS[9:])
            + (
                row.get("event_date", when.date().isoformat()),
                datetime.fromisoformat(row.get("ingest_ts", "2024-02-01 00:00:00")).replace(tzinfo=timezone.utc),
            )
        )
    return spark.createDataFrame(data, AUDIT_DDL)


def lookup(spark, *rows):
    """Merchant lookup of (merchant_id, merchant_name, merchant_category)."""
    return spark.createDataFrame(list(rows), "merchant_id string, merchant_name string, merchant_category string")
