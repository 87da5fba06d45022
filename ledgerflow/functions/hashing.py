"""The record hash: SHA-256 over a canonical rendering of the typed row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.measures import MONEY_TYPE
from ledgerflow.layout import METADATA_COLUMNS

# --- fixed values: the canonical form -----------------------------------------
FIELD_SEPARATOR = "|"
ESCAPE = "\\"
NULL_TEXT = "\\N"
# ------------------------------------------------------------------------------


def named(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def payload_columns(df: DataFrame, exclude: Iterable[str] = METADATA_COLUMNS) -> list[str]:
    """Columns the hash covers, in name order so that file column order is irrelevant."""
    excluded = set(exclude)
    return sorted(c for c in df.columns if c not in excluded)


def canonical_value(column: Column, data_type: T.DataType) -> Column:
    """One text per value, independent of session zone and of the file it came from.

    Separators inside text are escaped, so that two different rows never render
    alike and no text equals the mark for NULL.
    """
    if isinstance(data_type, T.DoubleType):
        money = column.try_cast(MONEY_TYPE)
        text = F.when(money.cast("double") == column, money.cast("string")).otherwise(column.cast("string"))
    elif isinstance(data_type, T.TimestampType):
        text = F.unix_micros(column).cast("string")
    elif isinstance(data_type, T.StringType):
        escaped = F.replace(column, F.lit(ESCAPE), F.lit(ESCAPE * 2))
        text = F.replace(escaped, F.lit(FIELD_SEPARATOR), F.lit(ESCAPE + FIELD_SEPARATOR))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def canonical_row(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """`name=value` pairs of the payload, in name order."""
    names = sorted(columns) if columns is not None else payload_columns(df)
    return F.concat_ws(
        FIELD_SEPARATOR,
        *[F.concat(F.lit(f"{n}="), canonical_value(named(n), df.schema[n].dataType)) for n in names],
    )


def record_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """64 hex digits identifying the payload of a row."""
    return F.sha2(canonical_row(df, columns), 256)
