from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest

from ledgerflow.functions.measures import MONEY_DIGITS
from ledgerflow.layout import DAILY_SUMMARY_COLUMNS, performance_columns
from ledgerflow.operators.trailing import running_sums, spread_sums, trailing_sums
from ledgerflow.plans import reports
from ledgerflow.plans.reports import (
    ReportRules,
    current_payments,
    daily_report,
    daily_totals,
    in_report_order,
    merchant_performance,
    merchant_tasks,
    performance_report,
)
from payments import audit, lookup, payment

SHOP = ("M1", "Shop", "RETAIL")


def daily(spark, rows, *merchants):
    return daily_report(audit(spark, rows), lookup(spark, *(merchants or [SHOP]))).collect()


def performance(spark, rows, days=7, merchants=(SHOP,)):
    return performance_report(audit(spark, rows), lookup(spark, *merchants), ReportRules(window_days=days)).collect()


def card(number, status, **values):
    return payment(f"T{number}", status=status, **values)


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([card(1, "DECLINED"), card(2, "DECLINED")], 0.0),
        ([card(1, "APPROVED"), card(2, "APPROVED")], 1.0),
        ([card(1, "APPROVED"), card(2, "APPROVED"), card(3, "DECLINED")], 0.6667),
        ([card(1, "APPROVED", payment_method="WALLET"), card(2, "DECLINED", payment_method="BANK_TRANSFER")], None),
        ([card(1, "REVERSED")], None),
        ([card(1, "APPROVED"), card(2, "PENDING"), card(3, "REVERSED"), card(4, "DECLINED", payment_method="WALLET")], 1.0),
    ],
)
def test_approval_rate(spark, rows, expected):
    assert {r["merchant_daily_approval_rate"] for r in daily(spark, rows)} == {expected}
    assert {r["merchant_daily_approval_rate_7d"] for r in performance(spark, rows)} == {expected}


def test_no_payments_no_rows(spark):
    assert daily(spark, []) == [] and performance(spark, []) == []


def test_daily_columns_and_measures(spark):
    rows = [card(1, "APPROVED", amount="100"), card(2, "APPROVED", amount="200"), card(3, "APPROVED", amount="300")]
    (row,) = daily(spark, rows)
    assert list(row.asDict()) == DAILY_SUMMARY_COLUMNS
    assert (row["event_date"], row["merchant_name"], row["merchant_category"]) == ("2024-01-15", "Shop", "RETAIL")
    assert (row["transaction_count"], row["total_amount"], row["avg_amount"], row["max_amount"]) == (3, 600, 200, 300)


def test_daily_grain(spark):
    rows = [
        card(1, "APPROVED"),
        card(2, "DECLINED"),
        card(3, "APPROVED", merchant_id="M2"),
        card(4, "APPROVED", currency="EUR"),
        card(5, "APPROVED", transaction_ts="2024-01-16 00:00:00"),
        card(6, "APPROVED"),
    ]
    result = daily(spark, rows)
    keys = {(r["event_date"], r["merchant_id"], r["currency"], r["status"]) for r in result}
    assert len(keys) == len(result) == 5


def test_status_change_counts_once(spark):
    rows = [
        card(1, "PENDING") | {"ingest_ts": "2024-02-01 00:00:00"},
        card(1, "APPROVED") | {"ingest_ts": "2024-02-02 00:00:00"},
    ]
    (row,) = daily(spark, rows)
    assert (row["status"], row["transaction_count"], row["total_amount"]) == ("APPROVED", 1, 100.0)


def test_unknown_merchant_keeps_its_payments(spark):
    (row,) = daily(spark, [card(1, "APPROVED", merchant_id="M9")])
    assert row["merchant_name"] is None and row["transaction_count"] == 1
    (row,) = performance(spark, [card(1, "APPROVED", merchant_id="M9")])
    assert row["merchant_name"] is None and row["total_transactions_7d"] == 1


def test_null_merchant_has_no_rate_and_no_performance(spark):
    rows = [card(1, "APPROVED", merchant_id=None), card(2, "APPROVED")]
    rates = {r["merchant_id"]: r["merchant_daily_approval_rate"] for r in daily(spark, rows)}
    assert rates == {None: None, "M1": 1.0}
    assert [r["merchant_id"] for r in performance(spark, rows)] == ["M1"]


def test_null_amount_counts_but_does_not_add(spark):
    (row,) = daily(spark, [card(1, "APPROVED", amount=None), card(2, "APPROVED", amount="10")])
    assert (row["transaction_count"], row["total_amount"], row["avg_amount"]) == (2, 10.0, 10.0)


def test_presentation_order_has_nulls_last(spark):
    rows = [card(1, "APPROVED", merchant_id=None), card(2, "DECLINED"), card(3, "APPROVED"), card(4, "APPROVED", merchant_id="M0")]
    report = in_report_order(daily_report(audit(spark, rows), lookup(spark, SHOP)))
    assert [(r["merchant_id"], r["status"]) for r in report.collect()] == [
        ("M0", "APPROVED"),
        ("M1", "APPROVED"),
        ("M1", "DECLINED"),
        (None, "APPROVED"),
    ]
    snapshots = in_report_order(performance_report(audit(spark, rows), lookup(spark, SHOP)))
    assert [r["merchant_id"] for r in snapshots.collect()] == ["M0", "M1"]


def test_repeated_merchant_multiplies_as_a_row_join_would(spark):
    rows = [card(1, "APPROVED", amount="10"), card(2, "DECLINED", amount="4")]
    twice = [SHOP, SHOP]
    approved = next(r for r in daily(spark, rows, *twice) if r["status"] == "APPROVED")
    assert (approved["transaction_count"], approved["total_amount"], approved["avg_amount"]) == (2, 20.0, 10.0)
    assert approved["merchant_daily_approval_rate"] == 0.5
    renamed = daily(spark, rows, SHOP, ("M1", "Other", "FOOD"))
    assert len(renamed) == 4 and {r["transaction_count"] for r in renamed} == {1}
    (row,) = performance(spark, rows, merchants=twice)
    assert (row["total_transactions_7d"], row["total_approved_amount_7d"], row["active_days_7d"]) == (4, 20.0, 1)


def test_window_width(spark):
    rows = [card(day, "APPROVED", transaction_ts=f"2024-01-{day} 10:00:00") for day in (13, 14, 15)]
    for days, expected in ((1, 1), (2, 2), (3, 3), (7, 3)):
        last = next(r for r in performance(spark, rows, days) if r["snapshot_date"] == "2024-01-15")
        assert last[f"total_transactions_{days}d"] == last[f"active_days_{days}d"] == expected
        assert list(last.asDict()) == performance_columns(days)


def test_idle_merchant_appears_while_in_the_window(spark):
    rows = [
        card(1, "APPROVED", transaction_ts="2024-01-01 10:00:00"),
        card(2, "APPROVED", merchant_id="M2", transaction_ts="2024-01-03 10:00:00"),
        card(3, "APPROVED", merchant_id="M2", transaction_ts="2024-01-09 10:00:00"),
    ]
    keys = {(r["snapshot_date"], r["merchant_id"]) for r in performance(spark, rows)}
    assert keys == {("2024-01-01", "M1"), ("2024-01-03", "M1"), ("2024-01-03", "M2"), ("2024-01-09", "M2")}


def test_window_must_be_positive(spark):
    with pytest.raises(ValueError, match="window_days"):
        performance(spark, [card(1, "APPROVED")], 0)


def brute_force_performance(rows, days):
    """Every snapshot against every payment, one by one."""
    dated = [(date.fromisoformat(r["transaction_ts"][:10]), r) for r in rows]
    result = {}
    for snapshot in sorted({d for d, _ in dated}):
        groups = defaultdict(list)
        for day, row in dated:
            if snapshot - timedelta(days - 1) <= day <= snapshot:
                groups[row["merchant_id"]].append((day, row))
        for merchant_id, members in groups.items():
            amounts = [float(r["amount"]) for _, r in members if r["status"] == "APPROVED"]
            cards = [r["status"] for _, r in members if r["payment_method"] == "CARD"]
            decided = [s for s in cards if s in ("APPROVED", "DECLINED")]
            reversed_ = sum(r["status"] == "REVERSED" for _, r in members)
            result[(snapshot.isoformat(), merchant_id)] = (
                len(members),
                round(sum(amounts), MONEY_DIGITS),
                round(decided.count("APPROVED") / len(decided), 4) if decided else None,
                round(reversed_ / len(members), 4) if reversed_ else None,
                len({d for d, _ in members}),
            )
    return result


@pytest.mark.parametrize(("seed", "days"), [(1, 1), (2, 3), (3, 7), (4, 30), (5, 400)])
def test_performance_against_brute_force(spark, seed, days):
    rng = random.Random(seed)
    rows = []
    for number in range(250):
        # One merchant holds a third of the payments; days are sparse with long gaps.
        merchant_id = "hot" if rng.random() < 0.33 else f"M{rng.randrange(8)}"
        when = date(2023, 12, 1) + timedelta(rng.choice([0, 1, 2, 5, 6, 7, 8, 20, 45, 46, 100]))
        rows.append(
            payment(
                f"T{number}",
                merchant_id=merchant_id,
                amount=f"{rng.randrange(1, 100_000) / 100:.2f}",
                status=rng.choice(["APPROVED", "DECLINED", "PENDING", "REVERSED"]),
                payment_method=rng.choice(["CARD", "WALLET"]),
                transaction_ts=f"{when} 12:00:00",
            )
        )
    actual = {(r[0], r[1]): tuple(r[3:]) for r in performance(spark, rows, days)}
    expected = brute_force_performance(rows, days)
    assert actual.keys() == expected.keys()
    for key in expected:
        assert actual[key] == pytest.approx(expected[key], abs=1e-9), key


@pytest.mark.parametrize("days", [1, 5, 30])
def test_both_ways_to_sum_agree(spark, days):
    rng = random.Random(days)
    active = {(f"k{rng.randrange(6)}", rng.randrange(90)) for _ in range(200)}
    rows = [(k, d, rng.randrange(100), Decimal(rng.randrange(10**9)) / 100) for k, d in sorted(active)]
    frame = spark.createDataFrame(rows, "k string, day int, x bigint, y decimal(38,2)")
    columns = ["k", "snapshot_day", "x", "y", "active_days"]

    def sums(limit):
        totals = trailing_sums(frame, "k", ["x", "y"], frame, days, spread_days=limit)
        return {(r[0], r[1]): tuple(r[2:]) for r in totals.select(*columns).collect()}

    spread, running = sums(60), sums(0)
    assert spread.keys() == running.keys()
    assert spread == running


@pytest.mark.parametrize("days", [7, 60, 61, 90])
def test_money_does_not_depend_on_partitions(spark, days):
    rng = random.Random(days)
    rows = [
        card(n, "APPROVED", merchant_id="M1", amount=f"{rng.randrange(10**12, 10**14) / 100:.2f}", transaction_ts=f"2024-01-{n % 28 + 1:02d} 09:00:00")
        for n in range(600)
    ]
    exact = sum(Decimal(r["amount"]) for r in rows)
    payments = audit(spark, rows)
    seen = set()
    for partitions in (1, 3, 7, 16):
        totals = daily_totals(current_payments(payments.repartition(partitions)))
        report = merchant_performance(totals, lookup(spark, SHOP), ReportRules(window_days=days))
        seen.add(tuple(sorted(map(tuple, report.collect()))))
    assert len(seen) == 1
    if days >= 28:
        assert max(r[4] for r in seen.pop()) == float(exact)


def test_sums_of_partitioned_days_shuffle_once(spark, capsys):
    totals = daily_totals(current_payments(audit(spark, [card(1, "APPROVED")])))
    for days in (7, 90):
        merchant_performance(totals, lookup(spark, SHOP), ReportRules(window_days=days)).explain()
        plan = capsys.readouterr().out
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(merchant_id" in line]
        assert not any("snapshot_day" in line for line in shuffles)


def test_tasks_over_merchants_follow_the_rows_of_the_result(spark, monkeypatch):
    rows = [(date(2024, 1, d), f"M{m}") for d in range(1, 11) for m in range(40) if (d + m) % 2]
    totals = spark.createDataFrame(rows, "event_date date, merchant_id string")
    # 200 rows are at most 200 x N of the result, and 40 merchants x 10 days.
    assert merchant_tasks(totals, 1, 10) == 20
    assert 35 <= merchant_tasks(totals, 2, 10) <= 40 and 35 <= merchant_tasks(totals, 7, 10) <= 45
    assert merchant_tasks(totals.limit(0), 7) == 1
    payments = audit(spark, [card(n, "APPROVED", merchant_id=f"M{n}") for n in range(60)])
    monkeypatch.setattr(reports, "merchant_tasks", lambda *_: 13)
    report = merchant_performance(daily_totals(current_payments(payments)), lookup(spark, SHOP), ReportRules(window_days=7))
    assert report.rdd.getNumPartitions() == 13


@pytest.mark.parametrize("sums", [spread_sums, running_sums])
def test_trailing_sums_with_given_snapshots(spark, sums):
    days = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 5, 50)], "k string, day int, x bigint")
    snapshots = spark.createDataFrame([(1,), (2,), (3,), (5,), (9,)], "day int")
    result = {r["snapshot_day"]: (r["x"], r["active_days"]) for r in sums(days, "k", ["x"], snapshots, 4).collect()}
    assert result == {1: (10, 1), 2: (30, 2), 3: (30, 2), 5: (70, 2)}
