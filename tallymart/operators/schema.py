"""Column discovery and the canonical order columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.contract import OrderContract


class MissingColumnsError(ValueError):
    """A file lacks columns the contract requires."""


def find_column(df: DataFrame, candidates: tuple[str, ...]) -> str | None:
    """First candidate that is a column, whatever its case; else None."""
    by_lower = {}
    for name in df.columns:
        by_lower.setdefault(name.lower(), name)
    return next((by_lower[c] for c in candidates if c in by_lower), None)


def resolve_columns(df: DataFrame, contract: OrderContract) -> dict[str, str]:
    """Contract name -> column of ``df``; raises before any job if one is missing."""
    found = {name: find_column(df, names) for name, names in contract.candidates.items()}
    missing = [name for name in contract.required if not found.get(name)]
    if missing:
        raise MissingColumnsError(f"Missing required columns {missing}. Found: {df.columns}")
    return {name: column for name, column in found.items() if column}


def canonical(df: DataFrame, contract: OrderContract) -> DataFrame:
    """The file's columns in their order, the resolved ones under contract names."""
    rename = {column: name for name, column in resolve_columns(df, contract).items()}
    return df.select(*[F.col(f"`{c}`").alias(rename.get(c, c)) for c in df.columns])


# Columns of a gold table that are never its dimension.
GOLD_FIXED = frozenset({"date", "year", "month", "total_sales", "revenue"})


def dimension_column(df: DataFrame) -> str | None:
    """The first column that is neither period nor measure."""
    return next((c for c in df.columns if c not in GOLD_FIXED), None)
