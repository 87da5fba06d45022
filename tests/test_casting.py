from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import casting
from ledgerflow.functions.measures import approval_rate, reversal_rate, round_to


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("129.99", 129.99),
        ("-5", -5.0),
        ("1e5", 100000.0),
        (" 12 ", 12.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("inf", float("inf")),
        ("-Infinity", float("-inf")),
        ("", None),
        ("N/A", None),
        ("1,000", None),
        ("nan", None),
        ("1.0d", None),
        ("2f", None),
        ("0x1p3", None),
        ("1_000", None),
        ("--1", None),
        (None, None),
    ],
)
def test_amount_text(spark, text, expected):
    assert value(spark, casting.parse_amount(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-15 09:12:33", datetime(2024, 1, 15, 9, 12, 33)),
        ("2024-01-15 09:12:33.123456", datetime(2024, 1, 15, 9, 12, 33, 123456)),
        ("2024-01-15T09:12:33Z", datetime(2024, 1, 15, 9, 12, 33)),
        ("2024-01-15T09:12:33+02:00", datetime(2024, 1, 15, 7, 12, 33)),
        ("2024-01-15", datetime(2024, 1, 15)),
        ("x", None),
        ("", None),
        ("09:12:33", None),
        ("T09:12", None),
        ("2024", None),
        ("2024-13-45 00:00:00", None),
        ("15/01/2024", None),
    ],
)
def test_timestamp_text(spark, text, expected):
    micros = value(spark, F.unix_micros(casting.parse_timestamp(F.lit(text))))
    wanted = expected and round(expected.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
    assert micros == wanted


def test_dates_and_flags(spark):
    assert value(spark, casting.parse_date(F.lit("2022-03-15"))) == date(2022, 3, 15)
    assert value(spark, casting.parse_date(F.lit("soon"))) is None
    flags = {" TRUE ": True, "true": True, "False": False, "yes": None, "": None, "1": None}
    assert {t: value(spark, casting.parse_flag(F.lit(t))) for t in flags} == flags
    assert value(spark, casting.date_text(F.lit("2024-01-15 23:59:59").cast("timestamp"))) == "2024-01-15"


def test_rounding_follows_the_binary_value(spark):
    cases = {1.005: 1.0, 2.675: 2.68, 0.125: 0.13, -0.125: -0.13, 214.495: 214.5}
    for number, expected in cases.items():
        assert value(spark, round_to(F.lit(number), 2)) == expected
    assert value(spark, round_to(F.lit(None).cast("double"), 2)) is None
    assert value(spark, round_to(F.lit(float("inf")), 2)) == float("inf")


def test_rates(spark):
    def rate(function, part, whole):
        return value(spark, function(F.lit(part).cast("bigint"), F.lit(whole).cast("bigint")))

    assert rate(approval_rate, 2, 3) == 0.6667
    assert rate(approval_rate, 0, 3) == 0.0
    assert rate(approval_rate, 0, 0) is None
    assert rate(reversal_rate, 1, 7) == 0.1429
    assert rate(reversal_rate, 0, 7) is None
