"""Trailing N-day sums per key, on a sparse set of snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Up to this window, adding every active day to each snapshot it reaches is the
# cheaper way; its cost grows with N, that of running sums does not. Whole
# numbers and decimals, as which money is added, come out the same either way.
SPREAD_DAYS = 60


def _calendar(snapshots: DataFrame) -> DataFrame:
    """Snapshot days for a broadcast: one INT per calendar day, a few megabytes for any range of dates."""
    return F.broadcast(snapshots.select(F.col("day").alias("snapshot_day")).distinct())


def active_spine(days: DataFrame, key: str, snapshots: DataFrame, window_days: int) -> DataFrame:
    """Every (snapshot, key) with activity in the trailing window, once each.

    `days` holds one row per key and active day (INT days since 1970 in `day`),
    `snapshots` one row per day. Each active day covers the snapshots up to the
    key's next active day, at most N-1 days ahead. The stretches of one key do
    not overlap, so the output has the size of the result: there is neither a
    date x key product nor N copies of every row. `day` stays on the row, so
    `day = snapshot_day` tells activity from filling.
    """
    if window_days < 1:
        raise ValueError(f"window_days must be at least 1, got {window_days}")
    next_day = F.lead("day").over(Window.partitionBy(key).orderBy("day"))
    last = F.least(F.col("day") + F.lit(window_days - 1), next_day - F.lit(1))
    spread = days.withColumn("_last", last).withColumn(
        "snapshot_day", F.explode(F.sequence(F.col("day"), F.col("_last")))
    )
    return spread.drop("_last").join(_calendar(snapshots), "snapshot_day", "left_semi")


def trailing_sums(
    days: DataFrame,
    key: str,
    measures: Sequence[str],
    snapshots: DataFrame,
    window_days: int,
    spread_days: int = SPREAD_DAYS,
) -> DataFrame:
    """Sums of `measures` and the number of active days over [snapshot - (N-1), snapshot].

    `days` holds one row per key and active day and should be partitioned by
    `key`: then neither way shuffles again.
    """
    if window_days < 1:
        raise ValueError(f"window_days must be at least 1, got {window_days}")
    if window_days <= spread_days:
        return spread_sums(days, key, measures, snapshots, window_days)
    return running_sums(days, key, measures, snapshots, window_days)


def spread_sums(
    days: DataFrame, key: str, measures: Sequence[str], snapshots: DataFrame, window_days: int
) -> DataFrame:
    """Every active day counts towards the N snapshots it reaches.

    The copies exist only inside a task: they go straight into the hash
    aggregation, which needs no shuffle on rows already partitioned by key.
    """
    reach = F.sequence(F.col("day"), F.col("day") + F.lit(window_days - 1))
    return (
        days.select(key, *measures, F.explode(reach).alias("snapshot_day"))
        .join(_calendar(snapshots), "snapshot_day", "left_semi")
        .groupBy(key, "snapshot_day")
        .agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("active_days"))
    )


def running_sums(
    days: DataFrame, key: str, measures: Sequence[str], snapshots: DataFrame, window_days: int
) -> DataFrame:
    """Windows over the spine, for long windows.

    Whole numbers and decimals are differences of two running sums, whose cost
    per row does not grow with N. Doubles are added up within each window, since
    a difference of running sums would lose their small digits.
    """
    spine = active_spine(days, key, snapshots, window_days)
    active = F.col("day") == F.col("snapshot_day")
    zeroed = spine.select(
        key,
        "snapshot_day",
        active.cast("bigint").alias("active_days"),
        *[F.when(active, F.col(m)).alias(m) for m in measures],
    )
    ordered = Window.partitionBy(key).orderBy("snapshot_day")
    until_now = ordered.rangeBetween(Window.unboundedPreceding, 0)
    before = ordered.rangeBetween(Window.unboundedPreceding, -window_days)
    within = ordered.rangeBetween(-(window_days - 1), 0)

    def total(name: str) -> Column:
        kind = zeroed.schema[name].dataType
        if isinstance(kind, T.IntegralType | T.DecimalType):
            sums = F.sum(name).over(until_now) - F.coalesce(F.sum(name).over(before), F.lit(0))
            return sums.cast(kind) if isinstance(kind, T.DecimalType) else sums
        return F.sum(name).over(within)

    return zeroed.select(key, "snapshot_day", *[total(m).alias(m) for m in [*measures, "active_days"]])
