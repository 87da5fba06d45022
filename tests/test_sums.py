from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.measures import FINE, exact_part, fine_part, inexact_part, money
from ledgerflow.plans.reports import ReportRules, daily_report, performance_report
from payments import audit, lookup, payment


def amounts(seed=1):
    rng = random.Random(seed)
    some = [0.1, 0.2, 0.1 + 0.2, 1 / 3, -2 / 3, 12.345, 1e-2 / 7, 123456789.123456, -0.005, 1e14 + 1 / 3, 2.0**52 + 0.5]
    return some + [rng.uniform(-1e6, 1e6) for _ in range(300)] + [round(rng.uniform(0, 1e4), 2) for _ in range(100)]


def value(amount):
    """What an amount counts as: its text if that has two digits at most, else its binary value."""
    text = Decimal(repr(amount)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return Fraction(text) if float(text) == amount else Fraction(amount)


def summed(frame):
    parts = frame.agg(*[F.sum(p(F.col("v"))).alias(n) for n, p in (("e", exact_part), ("f", fine_part), ("i", inexact_part))])
    return parts.select("e", "f", "i", money(F.col("e"), F.col("f"), F.col("i")).alias("total")).first()


@pytest.mark.parametrize("partitions", [1, 3, 7, 16])
def test_sums_are_exact_in_any_order(spark, partitions):
    values = amounts()
    random.Random(partitions).shuffle(values)
    row = summed(spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions))
    true = sum(map(value, values))
    assert Fraction(row["e"]) + Fraction(int(row["f"])) / Fraction(int(FINE)) == true and row["i"] is None
    assert math.isclose(row["total"], float(true), rel_tol=1e-15)


def test_what_no_unit_holds_is_added_beside(spark):
    tiny = 1e-9 / 3
    row = summed(spark.createDataFrame([(v,) for v in (1e300, tiny, 5.25)], "v double"))
    assert row["e"] == 5.25 and row["i"] >= 1e300 and row["total"] == 1e300
    (row,) = spark.createDataFrame([(tiny,)], "v double").select(
        fine_part(F.col("v")).alias("f"), inexact_part(F.col("v")).alias("i")
    ).collect()
    assert Fraction(int(row["f"])) / Fraction(int(FINE)) + Fraction(row["i"]) == Fraction(tiny)
    for value, total in ((math.inf, math.inf), (None, None)):
        assert summed(spark.createDataFrame([(value,), (value,)], "v double"))["total"] == total
    assert math.isnan(summed(spark.createDataFrame([(math.inf,), (-math.inf,)], "v double"))["total"])


def test_reports_have_the_same_digits_however_rows_lie(spark):
    rng = random.Random(7)
    values = [str(v) for v in amounts(3)[:150]] + ["1e300", "inf"]
    rows = [
        payment(f"T{n}", amount=v, merchant_id=f"M{n % 3}", transaction_ts=f"2024-01-{1 + rng.randrange(28):02} 10:00:00")
        for n, v in enumerate(values)
    ]
    names = lookup(spark, ("M1", "Shop", "RETAIL"))
    found = set()
    for partitions in (1, 3, 7, 16):
        rng.shuffle(rows)
        frame = audit(spark, rows).repartition(partitions)
        daily = sorted(map(tuple, daily_report(frame, names).collect()), key=str)
        found.add((str(daily), str(trailing(frame, names, 60)), str(trailing(frame, names, 61))))
    assert len(found) == 1
    (only,) = found
    assert only[1] == only[2]


def trailing(frame, names, days):
    rows = performance_report(frame, names, ReportRules(window_days=days)).collect()
    return sorted((tuple(r) for r in rows), key=str)
