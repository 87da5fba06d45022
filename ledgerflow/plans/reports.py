"""The two report tables as plans over the audit table.

Both start from one reduction, `daily_totals`, so the audit table is read and
shuffled once. Everything after it works on at most one row per date, merchant,
currency and status.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.casting import clean_amount
from ledgerflow.functions.measures import (
    MONEY_DIGITS,
    RATE_DIGITS,
    approval_rate,
    exact_part,
    fine_part,
    inexact_part,
    money,
    ratio,
    reversal_rate,
    round_to,
)
from ledgerflow.layout import (
    APPROVAL_DENOMINATOR,
    APPROVED,
    CARD,
    DAILY_SUMMARY_COLUMNS,
    REVERSED,
    WINDOW_DAYS,
    performance_columns,
)
from ledgerflow.operators.contracts import check_rate_arguments
from ledgerflow.operators.dedup import VERSION_TIE_BREAKERS, latest_per_transaction
from ledgerflow.operators.joins import broadcast_if_small
from ledgerflow.operators.trailing import trailing_sums
from ledgerflow.session import stage

@dataclass(frozen=True)
class ReportRules:
    """Parameters of the two reports."""

    window_days: int = WINDOW_DAYS
    approved_status: str = APPROVED
    denominator_statuses: Sequence[str] = APPROVAL_DENOMINATOR
    payment_method: str = CARD
    reversed_status: str = REVERSED

    def __post_init__(self) -> None:
        if self.window_days < 1:
            raise ValueError(f"window_days must be at least 1, got {self.window_days}")
        check_rate_arguments(
            self.payment_method, self.denominator_statuses, self.approved_status, self.reversed_status
        )


# The only audit columns a report reads: no personal data among them.
REPORT_INPUT = ["transaction_id", "event_date", "merchant_id", "currency", "status", "payment_method", "amount"]


def current_payments(audit: DataFrame, tie_breakers: Sequence[str] = VERSION_TIE_BREAKERS) -> DataFrame:
    """Each transaction once, in its newest version, without personal data.

    Dates become DATE before the shuffle; text that is no date is an error.
    """
    dated = audit.withColumn("event_date", F.col("event_date").cast("date"))
    return latest_per_transaction(dated, REPORT_INPUT, tie_breakers)


def daily_totals(current: DataFrame, payment_method: str = CARD) -> DataFrame:
    """Counts and sums per (event_date, merchant_id, currency, status).

    Money is added as whole numbers: two digits after the point as decimals,
    finer fractions in units of 2^-62, so sums do not depend on how rows are
    partitioned. Only what no such unit holds (1e300, inf, digits of amounts
    below 0.001) is added as doubles beside it.
    Partial aggregation runs before the shuffle, so a merchant with a third of
    all payments sends one row per task and group.
    """
    return (
        current.withColumn("amount", clean_amount(F.col("amount")))
        .groupBy("event_date", "merchant_id", "currency", "status")
        .agg(
            F.count("transaction_id").alias("transactions"),
            F.count(F.lit(1)).alias("payments"),
            F.sum(exact_part(F.col("amount"))).alias("amount_exact"),
            F.sum(fine_part(F.col("amount"))).alias("amount_fine"),
            F.sum(inexact_part(F.col("amount"))).alias("amount_inexact"),
            F.count("amount").alias("amounts"),
            F.max("amount").alias("amount_max"),
            F.count_if(F.col("payment_method") == payment_method).alias("rated_payments"),
        )
    )


def _rated(statuses: Sequence[str]) -> Column:
    """Rated-method payments of a totals row if its status is one of these, else 0."""
    return F.when(F.col("status").isin(list(statuses)), F.col("rated_payments")).otherwise(0)


def with_daily_approval_rate(totals: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """Totals plus the approval rate of their (event_date, merchant_id, currency).

    A window over the reduced rows replaces a second aggregation joined back.
    A group with a NULL in its key has no rate, as in an equality join.
    """
    group = ["event_date", "merchant_id", "currency"]
    over = Window.partitionBy(*group)
    rate = approval_rate(
        F.sum(_rated([rules.approved_status])).over(over), F.sum(_rated(rules.denominator_statuses)).over(over)
    )
    complete = F.col("event_date").isNotNull() & F.col("merchant_id").isNotNull() & F.col("currency").isNotNull()
    return totals.withColumn("approval_rate", F.when(complete, rate))


def daily_approval_rates(totals: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """The approval rate alone, one row per (event_date, merchant_id, currency)."""
    rate = approval_rate(F.sum(_rated([rules.approved_status])), F.sum(_rated(rules.denominator_statuses)))
    return totals.groupBy("event_date", "merchant_id", "currency").agg(rate.alias("approval_rate"))


def daily_payment_summary(totals: DataFrame, merchants: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """One row per (event_date, merchant_id, currency, status) with merchant attributes.

    The lookup is joined after the reduction. `copies` restores what joining
    every payment would give if the lookup lists a merchant more than once.
    """
    attributes = merchants.select("merchant_id", "merchant_name", "merchant_category")
    lookup = attributes.groupBy(*attributes.columns).agg(F.count(F.lit(1)).alias("copies"))
    copies = F.coalesce("copies", F.lit(1))
    total = money(F.col("amount_exact"), F.col("amount_fine"), F.col("amount_inexact"))
    return (
        with_daily_approval_rate(totals, rules)
        .join(broadcast_if_small(lookup, bound=attributes), "merchant_id", "left")
        .select(
            F.col("event_date").cast("string").alias("event_date"),
            "merchant_id",
            "merchant_name",
            "merchant_category",
            "currency",
            "status",
            (F.col("transactions") * copies).alias("transaction_count"),
            round_to(total * copies, MONEY_DIGITS).alias("total_amount"),
            round_to(ratio(total, F.col("amounts")), RATE_DIGITS).alias("avg_amount"),
            F.col("amount_max").alias("max_amount"),
            F.col("approval_rate").alias("merchant_daily_approval_rate"),
        )
        .select(*DAILY_SUMMARY_COLUMNS)
    )


PERFORMANCE_SUMS = ["payments", "approved_exact", "approved_fine", "approved_inexact", "rated_approved", "rated_decided", "reversals"]


# Rows of a merchant table that one task adds up: some 300 MB, as a row takes about 500 bytes there.
TASK_ROWS = 500_000


def merchant_tasks(totals: DataFrame, window_days: int, task_rows: int = TASK_ROWS) -> int:
    """Tasks over merchants, so that each has about `task_rows` rows of a `window_days` table.

    A shuffle of the totals says little about that: a row of them turns into as many as the window has days, but no
    merchant has more rows than there are snapshots. Merchants and days are estimated, in one pass over the totals.
    """
    size = totals.filter(F.col("event_date").isNotNull() & F.col("merchant_id").isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.approx_count_distinct("merchant_id").alias("merchants"),
        F.approx_count_distinct("event_date").alias("days"),
    ).first()
    rows = min(size["rows"] * window_days, max(size["rows"], size["merchants"] * size["days"]))
    return max(1, -(-rows // task_rows))


def merchant_days(totals: DataFrame, rules: ReportRules = ReportRules(), tasks: int | None = None) -> DataFrame:
    """Totals reduced to one row per merchant and active day (`day` = days since 1970).

    Shuffled by merchant alone, so that the windows that follow need no further
    shuffle; a merchant has a bounded number of rows per day by now. `tasks` is
    the number of tasks if what follows makes more rows of them (`merchant_tasks`).
    """
    approved = F.col("status") == rules.approved_status
    is_reversed = F.col("status") == rules.reversed_status
    return (
        totals.filter(F.col("event_date").isNotNull() & F.col("merchant_id").isNotNull())
        # One task would gather all merchants, whatever the session is set to.
        .repartition(*([max(2, tasks)] if tasks else []), "merchant_id")
        .groupBy("merchant_id", F.unix_date("event_date").alias("day"))
        .agg(
            F.sum("payments").alias("payments"),
            F.coalesce(F.sum(F.when(approved, F.col("amount_exact"))), F.lit(0)).cast("decimal(38,2)").alias("approved_exact"),
            F.coalesce(F.sum(F.when(approved, F.col("amount_fine"))), F.lit(0)).cast("decimal(38,0)").alias("approved_fine"),
            F.sum(F.when(approved, F.col("amount_inexact"))).alias("approved_inexact"),
            F.sum(_rated([rules.approved_status])).alias("rated_approved"),
            F.sum(_rated(rules.denominator_statuses)).alias("rated_decided"),
            F.sum(F.when(is_reversed, F.col("payments")).otherwise(0)).alias("reversals"),
        )
    )


def snapshot_days(totals: DataFrame) -> DataFrame:
    """The dates that get a snapshot: those with a payment, not every calendar day."""
    return totals.filter("event_date IS NOT NULL").select(F.unix_date("event_date").alias("day")).distinct()


def merchant_names(listed: DataFrame) -> DataFrame:
    """One name per merchant, and how often the lookup lists the merchant."""
    return listed.groupBy("merchant_id").agg(
        F.min("merchant_name").alias("merchant_name"), F.count(F.lit(1)).alias("copies")
    )


def merchant_performance(totals: DataFrame, merchants: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """One row per snapshot date and merchant active in the N days that end on it.

    `totals` is read three times (size, measures and snapshot dates), so pass a staged table.
    """
    window_days = rules.window_days
    listed = merchants.select("merchant_id", "merchant_name")
    names = merchant_names(listed)
    days = merchant_days(totals, rules, merchant_tasks(totals, window_days))
    sums = trailing_sums(days, "merchant_id", PERFORMANCE_SUMS, snapshot_days(totals), window_days)
    copies = F.coalesce("copies", F.lit(1))
    approved = money(F.col("approved_exact"), F.col("approved_fine"), F.col("approved_inexact"))
    measures = {
        "total_transactions": F.col("payments") * copies,
        "total_approved_amount": round_to(approved * copies, MONEY_DIGITS),
        "merchant_daily_approval_rate": approval_rate(F.col("rated_approved"), F.col("rated_decided")),
        "reversal_rate": reversal_rate(F.col("reversals"), F.col("payments")),
        "active_days": F.col("active_days"),
    }
    return (
        sums.join(broadcast_if_small(names, bound=listed), "merchant_id", "left")
        .select(
            F.date_from_unix_date("snapshot_day").cast("string").alias("snapshot_date"),
            "merchant_id",
            "merchant_name",
            *[column.alias(f"{name}_{window_days}d") for name, column in measures.items()],
        )
        .select(*performance_columns(window_days))
    )


def daily_report(audit: DataFrame, merchants: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """The daily summary straight from audit rows."""
    return daily_payment_summary(daily_totals(current_payments(audit), rules.payment_method), merchants, rules)


def performance_report(audit: DataFrame, merchants: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """The N-day merchant table straight from audit rows."""
    totals = stage(daily_totals(current_payments(audit), rules.payment_method), "daily-totals")
    return merchant_performance(totals, merchants, rules)


def in_report_order(report: DataFrame) -> DataFrame:
    """Sorted by date and keys for presentation, NULLs last; writing a table needs no order."""
    keys = ["snapshot_date", "event_date", "merchant_id", "currency", "status"]
    return report.orderBy(*[F.asc_nulls_last(c) for c in keys if c in report.columns])
