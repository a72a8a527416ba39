"""The registered queries: all thirteen are there, and those with a SQL twin agree with it."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, duckdb_rows, spark_rows, types_agree
from tallymart.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    with connect(sf_dir) as con:
        expected_columns, expected = duckdb_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert types_agree(rows, expected)
