"""Lineage columns of the audit table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.hashing import payload_columns, record_hash
from ledgerflow.layout import METADATA_COLUMNS


def new_run_id() -> str:
    return str(uuid4())


def run_clock() -> datetime:
    """One instant per run; `current_timestamp()` would differ from query to query."""
    return datetime.now(timezone.utc)


def enrich(
    df: DataFrame,
    source_file: str | Column,
    run_id: str | None = None,
    ingest_ts: datetime | None = None,
    exclude: Iterable[str] = METADATA_COLUMNS,
) -> DataFrame:
    """Add record_hash, ingest_ts, ingest_run_id and source_file.

    The hash covers the payload only, and columns of these four names that came
    with the input are replaced, not hashed.
    """
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns(
        {
            "record_hash": record_hash(df, payload_columns(df, exclude)),
            "ingest_ts": F.lit(ingest_ts or run_clock()),
            "ingest_run_id": F.lit(run_id or new_run_id()),
            "source_file": source,
        }
    )
