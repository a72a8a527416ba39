"""Gold marts: one silver scan for all of them, and SQL views over the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.contract import AUDIT_SCHEMA, gold_schema
from tallymart.operators.aggregates import monthly_revenue, roll_up
from tallymart.plans.corrections import published, read_log
from tallymart.sources.paths import LakePaths
from tallymart.sources.readers import read_optional

MARTS: dict[str, tuple[str, ...]] = {
    "monthly_revenue": (),
    "monthly_revenue_by_category": ("category",),
}


def available_marts(columns: list[str], marts: dict[str, tuple[str, ...]]) -> dict:
    """The marts whose dimensions the table has; the others are skipped."""
    return {name: dims for name, dims in marts.items() if set(dims) <= set(columns)}


def base_aggregate(silver: DataFrame, marts: dict[str, tuple[str, ...]]) -> DataFrame:
    """Sales at the finest grain the marts need: the only pass over the rows."""
    dims = dict.fromkeys(d for mart in marts.values() for d in mart)
    return monthly_revenue(silver, *dims)


def mart_tables(base: DataFrame, marts: dict[str, tuple[str, ...]]) -> dict[str, DataFrame]:
    return {name: roll_up(base, *dims) for name, dims in marts.items()}


def read_gold(
    spark: SparkSession, paths: LakePaths, mart: str, dims: tuple[str, ...] = ()
) -> DataFrame | None:
    """A gold table, or None where the run did not build it."""
    return read_optional(spark, paths.gold(mart), gold_schema(dims))


def read_gold_batches(
    spark: SparkSession, paths: LakePaths, mart: str, dims: tuple[str, ...] = ()
) -> DataFrame | None:
    """Gold over all ingested batches.

    Each batch stores its own sums, so a new batch costs what it brings and a
    late file for an old month needs no re-read of that month.  Where batches
    correct earlier ones their sums are differences, and a group whose rows are
    all gone is left out.
    """
    schema = gold_schema(dims).add("n_rows", "long").add("batch_id", "string")
    partial = read_optional(spark, paths.gold_batches(mart), schema)
    if partial is None:
        return None
    if read_log(spark, paths) is None:
        return roll_up(partial, *dims)
    sums = published(partial, paths).groupBy("year", "month", *dims).agg(
        F.sum("total_sales").alias("total_sales"), F.sum("n_rows").alias("_n")
    )
    return sums.where("_n > 0").drop("_n")


def register_views(
    spark: SparkSession,
    paths: LakePaths,
    marts: dict[str, tuple[str, ...]] = MARTS,
    prefix: str = "gold_",
) -> list[str]:
    """Temporary SQL views over the gold tables that exist."""
    names = []
    for mart, dims in marts.items():
        gold = read_gold(spark, paths, mart, dims)
        if gold is not None:
            gold.createOrReplaceTempView(prefix + mart)
            names.append(prefix + mart)
    return names


def save_tables(
    spark: SparkSession,
    paths: LakePaths,
    database: str,
    marts: dict[str, tuple[str, ...]] = MARTS,
) -> list[str]:
    """Catalog tables over the gold folders that exist; the data stays where it is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for mart, dims in marts.items():
        if read_gold(spark, paths, mart, dims) is not None:
            name = f"{database}.{mart}"
            if not spark.catalog.tableExists(name):
                spark.catalog.createTable(name, paths.gold(mart), "parquet", gold_schema(dims))
            spark.catalog.refreshTable(name)
            names.append(name)
    return names


def audit_log(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """All runs, newest first."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(paths.audit).orderBy(F.desc("finished_at"), "run_id")
