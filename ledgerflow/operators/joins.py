"""Fact to dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Counted for every value besides its text.
VALUE_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows: their text plus a fixed overhead per value, from one aggregation over `df`."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
        F.lit(VALUE_BYTES * len(df.columns)),
    )
    return int(df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("n")).first()["n"])


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the measured size stays within the limit.

    The row count alone decides for a large table; of a stored one it is read
    from the file footers, without touching a value.
    """
    return df.count() * VALUE_BYTES * len(df.columns) <= limit_bytes and measured_bytes(df) <= limit_bytes


def broadcast_if_small(
    df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES, bound: DataFrame | None = None
) -> DataFrame:
    """Hint a broadcast only for a side measured to fit; otherwise leave the choice to Spark,
    which then shuffles both sides and splits hot keys (AQE skew join).

    `bound` is a frame that cannot be smaller than `df` and is cheaper to measure,
    such as the table `df` aggregates.
    """
    return F.broadcast(df) if fits_broadcast(df if bound is None else bound, limit_bytes) else df


def left_join_dimension(
    fact: DataFrame, dimension: DataFrame, key: str, limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Every fact row, with NULL attributes where the dimension has no such key.

    A repeated dimension key repeats the fact row. Beyond the broadcast limit
    pass a stored or staged dimension: AQE splits a hot key of the facts only if
    both sides of the join come straight from a shuffle.
    """
    return fact.join(broadcast_if_small(dimension, limit_bytes), key, "left")
