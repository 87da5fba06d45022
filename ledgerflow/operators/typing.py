"""Raw text columns to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.casting import date_text, parse_amount, parse_date, parse_flag, parse_timestamp


def type_payments(raw: DataFrame) -> DataFrame:
    """Cast amount and timestamp and derive the event date."""
    return raw.withColumns(
        {"amount": parse_amount(F.col("amount")), "transaction_ts": parse_timestamp(F.col("transaction_ts"))}
    ).withColumn("event_date", date_text(F.col("transaction_ts")))


def type_merchants(raw: DataFrame) -> DataFrame:
    """Cast the onboarding date and the active flag."""
    return raw.withColumns(
        {"onboarding_date": parse_date(F.col("onboarding_date")), "is_active": parse_flag(F.col("is_active"))}
    )
