"""Lenient casts from CSV text: text that does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the text forms that count as a value -----------------------
# Plain or scientific decimals and infinities. Without this guard the JVM cast
# would also take `1.0d`, `0x1p3` and `nan`.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
# A complete calendar date comes first. Without it the cast would read `09:00`
# as today at nine, and `2024` as New Year.
DATE_PREFIX_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
# Further forms of a time, tried in order after ISO: (what the text looks like, how Spark reads it). Month comes before
# day between slashes.
TIME_FORMATS = (
    (r"^\s*\d{1,2}/\d{1,2}/\d{4}[ T]+\d{1,2}:\d{2}:\d{2}\s*$", "M/d/yyyy H:mm:ss"),
    (r"^\s*\d{1,2}/\d{1,2}/\d{4}[ T]+\d{1,2}:\d{2}\s*$", "M/d/yyyy H:mm"),
    (r"^\s*\d{1,2} [A-Za-z]{3} \d{4} +\d{1,2}:\d{2}:\d{2}\s*$", "d MMM yyyy H:mm:ss"),
    (r"^\s*\d{1,2} [A-Za-z]{3} \d{4} +\d{1,2}:\d{2}\s*$", "d MMM yyyy H:mm"),
)
TRUE_TEXT = "true"
FALSE_TEXT = "false"
# ------------------------------------------------------------------------------


def parse_amount(text: Column) -> Column:
    """Text to DOUBLE; blanks, words, thousands separators and NaN become NULL."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def clean_amount(value: Column) -> Column:
    """An already numeric amount as DOUBLE, with NaN as NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def parse_timestamp(text: Column) -> Column:
    """Text to TIMESTAMP: ISO, or one of TIME_FORMATS; text without a zone is UTC (the session zone)."""
    parsed = F.when(text.rlike(DATE_PREFIX_PATTERN), F.try_to_timestamp(text))
    for pattern, form in TIME_FORMATS:
        # Runs of spaces count as one, as the format has single ones.
        spaced = F.regexp_replace(F.trim(text), "[ T]+", " ")
        parsed = parsed.when(text.rlike(pattern), F.try_to_timestamp(spaced, F.lit(form)))
    return parsed


def parse_date(text: Column) -> Column:
    """ISO text to DATE."""
    return F.when(text.rlike(DATE_PREFIX_PATTERN), F.to_date(F.try_to_timestamp(text)))


def parse_flag(text: Column) -> Column:
    """`true`/`false` in any case and padding to BOOLEAN, anything else to NULL."""
    word = F.lower(F.trim(text))
    return F.when(word == TRUE_TEXT, F.lit(True)).when(word == FALSE_TEXT, F.lit(False))


def date_text(value: Column) -> Column:
    """DATE or TIMESTAMP to `YYYY-MM-DD`."""
    return F.to_date(value).cast("string")
