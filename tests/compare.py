"""Compares a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return 0.0 if value == 0 and isinstance(value, float) else value


def _rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(shaped, key=lambda row: [(v is None, str(v)) for v in row])


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def types_agree(left: list[tuple], right: list[tuple]) -> bool:
    """Same Python type column by column wherever both have a value."""
    return all(
        a is None or b is None or type(a) is type(b) for x, y in zip(left, right) for a, b in zip(x, y)
    )
