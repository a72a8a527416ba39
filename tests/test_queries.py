"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, duckdb_rows, spark_rows, types_agree
from tallymart.oracles import ORACLES
from tallymart.registry import REGISTRY as QUERIES

# Joins of everything with everything, and row work outside the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas")


@pytest.fixture(scope="module")
def con(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns, rows = spark_rows(df)
    expected_columns, expected = duckdb_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert types_agree(rows, expected)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    # a scalar subquery is planned on its own, so it may only read stored results
    assert "Subquery" not in plan or "lineitem.parquet" not in plan


def test_entry(spark, sf_dir):
    df = contract.entry(spark)
    assert df.columns == ["year", "month", "total_sales"] and df.count() > 0
