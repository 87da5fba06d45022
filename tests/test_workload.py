"""Every query against its SQL on the smallest driver tables, and the plans of the heavy ones."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from check import TABLES, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES

SMALL = Path(contract.SMOKE_DATA)
pytestmark = pytest.mark.skipif(not SMALL.is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as connection:
        for table in TABLES.split():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
        yield connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_with_a_plan_for_scale(spark, oracle, capsys, name):
    query = QUERIES[name](spark, str(SMALL))
    query.explain()
    plan = capsys.readouterr().out
    # No product of rows, no Python worker, no step that gathers all rows in one task.
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval", "SinglePartition"):
        assert unwanted not in plan, unwanted
    actual = query.toPandas()
    assert len(actual) > 0
    assert difference(actual, oracle.execute(ORACLES[name]).df()) is None


def test_flagship_has_a_stable_schema(spark):
    from ledgerflow.layout import DAILY_SUMMARY_COLUMNS

    assert contract.entry(spark).columns == DAILY_SUMMARY_COLUMNS


def test_date_filter_prunes_partitions(spark, capsys):
    contract.queries()["scan_partition_prune"](spark, str(SMALL)).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [event_date" in plan
    assert "ReadSchema: struct<transaction_id:string,amount:double>" in plan


def test_projection_reaches_the_scan(spark, capsys):
    contract.queries()["scan_project"](spark, str(SMALL)).explain()
    assert "ReadSchema: struct<transaction_id:string,status:string>" in capsys.readouterr().out
