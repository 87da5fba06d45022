"""Queries that SQL can express, against SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

from ledgerflow.llm.oracles import ORACLES
from ledgerflow.llm.queries import QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from check import difference  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="the driver's tables are absent")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "embeddings"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
        assert difference(QUERIES[name](spark, FOLDER).toPandas(), db.execute(ORACLES[name]).df()) is None
