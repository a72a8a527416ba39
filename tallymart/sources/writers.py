"""Silver, gold, quarantine and audit sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.contract import AUDIT_SCHEMA

PERIOD = ("year", "month")

# Quotes are doubled and blanks at the ends of a value are kept.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: Of jobs that move whole tables: Parquet in the denser codec, and a job's shuffle files go when it ends
#: instead of when the driver happens to collect its garbage.
LEAN_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one key side by side, if keys are given, in files of the advisory size.

    A rebalance, unlike a hash repartition, lets AQE split a key that holds too
    much data over several tasks and merge the small ones.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys])


def as_is(df: DataFrame) -> DataFrame:
    return df


def write_silver(
    df: DataFrame, path: str, mode: str = "overwrite", finish: Callable[[DataFrame], DataFrame] = as_is
) -> None:
    """``finish`` adds columns that rows can do without in the shuffle."""
    finish(balanced(df, *PERIOD)).write.mode(mode).partitionBy(*PERIOD).parquet(path)


def write_batch(
    df: DataFrame, path: str, keys: tuple[str, ...] = (), finish: Callable[[DataFrame], DataFrame] = as_is
) -> None:
    """Publish one batch below ``batch_id=``; a replayed batch replaces itself.

    ``finish`` adds columns that rows can do without in the shuffle, such as a constant ``batch_id``.
    """
    laid_out = balanced(df, *[k for k in ("batch_id", *keys) if k in df.columns]) if keys else df
    (
        finish(laid_out).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", *keys)
        .parquet(path)
    )


def write_silver_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Silver as flat CSV, one file per task."""
    flat = [
        F.col(f.name).cast("string") if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_gold(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def export_csv(df: DataFrame, path: str, *order: str, one_file: bool = True) -> None:
    """Sorted CSV: one file, written by one task, for totals by period; else sorted parts
    in name order, as many as the data fills."""
    ordered = df.orderBy(*order) if order else df
    ordered = ordered.coalesce(1) if one_file else ordered
    ordered.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_quarantine(
    bad: DataFrame, path: str, run_id: str, finish: Callable[[DataFrame], DataFrame] = as_is
) -> None:
    """All rejects of a run below ``run_id=``; a repeated run replaces its own."""
    (
        finish(balanced(bad.withColumn("run_id", F.lit(run_id))))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def write_audit(spark: SparkSession, path: str, row: dict) -> DataFrame:
    """One run's audit row below ``run_id=``; a replayed run replaces its own."""
    values = tuple(row.get(f.name) for f in AUDIT_SCHEMA)
    table = spark.createDataFrame([values], AUDIT_SCHEMA)
    (
        table.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
    return table
