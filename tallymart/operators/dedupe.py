"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_exact(df: DataFrame) -> DataFrame:
    """One of each set of equal rows."""
    return df.dropDuplicates()


def dedupe_latest(df: DataFrame, keys: list[str], latest_first: list[str | Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Order by enough columns to leave no ties.  With the ``= 1`` filter Spark
    limits each key to one row per task before the shuffle, so a key that holds
    much of the table does not meet in one task.
    """
    order = Window.partitionBy(*keys).orderBy(*latest_first)
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1).drop("_n")
