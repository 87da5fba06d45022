"""What happens to each typed row: stored, set aside, or outside the run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.dates import DateRange

# --- fixed values -------------------------------------------------------------
ACCEPTED = "accepted"
BAD_AMOUNT = "bad_amount"
BAD_TIMESTAMP = "bad_timestamp"
OUT_OF_RANGE = "out_of_range"
# ------------------------------------------------------------------------------


def row_fate(dates: DateRange | None = None) -> Column:
    """The first rule that applies to a typed payment.

    Amounts are judged before dates, so a bad amount counts as quarantined in
    a backfill of other dates as well.
    """
    fate = F.when(F.col("amount").isNull() | F.isnan("amount"), BAD_AMOUNT).when(
        F.col("event_date").isNull(), BAD_TIMESTAMP
    )
    if dates is not None:
        fate = fate.when(~dates.holds(F.col("event_date")), OUT_OF_RANGE)
    return fate.otherwise(ACCEPTED)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("fate") == ACCEPTED).drop("fate")


def quarantined(df: DataFrame) -> DataFrame:
    """Rows set aside, with the rule as `reason`."""
    return df.filter(F.col("fate").isin(BAD_AMOUNT, BAD_TIMESTAMP)).withColumnRenamed("fate", "reason")
