"""Rates, rounding and the conditional counts behind the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
MONEY_DIGITS = 2
MONEY_TYPE = "decimal(18,2)"
RATE_DIGITS = 4
# Amounts of this size and more are whole numbers or have at most two digits after the point.
WHOLE_LIMIT = 1e15
# Units of a fraction: a long holds them, and 62 binary digits are all that an amount of 0.001 or more has.
FINE = float(1 << 62)
# ------------------------------------------------------------------------------


def round_to(value: Column, digits: int) -> Column:
    """Round a DOUBLE half away from zero on its scaled binary value.

    F.round works on the shortest decimal text instead, so 1.005 would become
    1.01 although the double lies below the half.
    """
    scale = float(10**digits)
    scaled = value * scale
    # A value too large to be scaled has no digits to round.
    return F.when(F.abs(scaled) < float("inf"), F.round(scaled) / scale).otherwise(value)


def _parts(amount: Column) -> tuple[Column, Column, Column, Column]:
    """Whether an amount has two digits at most, whether it is finer than that, and then its whole part and the rest in units of FINE."""
    two_digits = amount.try_cast(MONEY_TYPE).cast("double") == amount
    # A double has no fraction beyond this size, so every finer amount fits in the money type. NaN counts as larger.
    finer = (F.coalesce(two_digits, F.lit(False)) == F.lit(False)) & (F.abs(amount) < WHOLE_LIMIT)
    whole = F.when(finer, amount).cast("bigint")
    # Both steps are exact: the fraction has some of the amount's binary digits, and scaling moves them.
    return two_digits, finer, whole, (F.when(finer, amount) - whole.cast("double")) * FINE


def exact_part(amount: Column) -> Column:
    """Of a DOUBLE amount with at most two digits all, of a finer one the whole part, else NULL: a decimal.

    Together with `fine_part` the sums are those of the amounts themselves, with no rounding in between, so they do not
    depend on the order or grouping of rows.
    """
    two_digits, finer, whole, _ = _parts(amount)
    return F.when(two_digits, amount.try_cast(MONEY_TYPE)).when(finer, whole.cast(MONEY_TYPE))


def fine_part(amount: Column) -> Column:
    """The fraction of a finer amount in units of 1 / FINE, a decimal; else NULL."""
    _, finer, _, scaled = _parts(amount)
    return F.when(finer, scaled.cast("bigint").cast("decimal(20,0)"))


def inexact_part(amount: Column) -> Column:
    """What the other parts leave of a DOUBLE amount, or NULL: all of a huge or infinite one, the digits below 1 / FINE of a tiny one."""
    two_digits, finer, _, scaled = _parts(amount)
    below = (scaled - scaled.cast("bigint").cast("double")) / FINE
    return F.when(two_digits, F.lit(None)).when(finer, F.nullif(below, F.lit(0.0))).otherwise(amount)


def money(exact: Column, fine: Column, inexact: Column) -> Column:
    """The DOUBLE total of the summed parts, NULL if none has a value."""
    fraction = F.coalesce(fine.cast("double") / FINE, F.lit(0.0))
    return F.coalesce(exact.cast("double") + fraction + F.coalesce(inexact, F.lit(0.0)), inexact)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as DOUBLE, NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def approval_rate(approved: Column, attempts: Column) -> Column:
    """Share of approved among decided card payments: NULL without attempts, 0 if all declined."""
    return round_to(ratio(approved, attempts), RATE_DIGITS)


def reversal_rate(reversals: Column, payments: Column) -> Column:
    """Share of reversed payments; NULL (not 0) when nothing was reversed."""
    return round_to(ratio(F.nullif(reversals, F.lit(0)), payments), RATE_DIGITS)

