"""Column profile, null rates and schema drift."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.session import written

DRIFT_SCHEMA = "column string, expected_type string, actual_type string, status string"


def _spread(entries) -> list:
    return [F.inline(F.array(*[F.struct(*e) for e in entries]))]


def null_rates(df: DataFrame) -> DataFrame:
    """Rows, nulls and null share of every column, in one pass."""
    present = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *present)
    entries = []
    for i, name in enumerate(df.columns):
        nulls = F.col("rows") - F.col(f"n{i}")
        rate = F.try_divide(nulls.cast("double"), F.col("rows").cast("double"))
        entries.append(
            (
                F.lit(name).alias("column"),
                F.col("rows").alias("rows"),
                nulls.alias("nulls"),
                rate.alias("null_rate"),
            )
        )
    return counts.select(*_spread(entries))


def profile(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Type, rows, nulls and the numeric summary of every column, in one pass.

    ``accuracy`` adds approximate quartiles with rank error ``rows / accuracy``
    to the same pass; ``exact_quantiles`` has the exact ones.
    """
    summary = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if accuracy is not None:
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            summary[name] = lambda x, p=p: F.percentile_approx(x, p, accuracy)
    aggregates, entries = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema):
        c = F.col(f"`{f.name}`")
        aggregates.append(F.count(c).alias(f"n{i}"))
        entry = [
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("rows").alias("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
        ]
        for name, function in summary.items():
            statistic = F.lit(None).cast("double")
            if isinstance(f.dataType, T.NumericType):
                aggregates.append(function(c.cast("double")).alias(f"{name}{i}"))
                statistic = F.col(f"{name}{i}")
            entry.append(statistic.alias(name))
        entries.append(entry)
    return df.agg(*aggregates).select(*_spread(entries))


def exact_quantiles(
    df: DataFrame, points: tuple[float, ...] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Interpolated quantiles of every numeric column, exact for values that a double holds.

    Whole numbers beyond 2^53 and wider decimals are rounded to doubles first.
    The values of all numeric columns go through one shuffle, counted per task
    before it: its size is that of their distinct values.

    Values are counted first, so a frequent value is one row, then range
    partitioned and stored with their partition number.  The partitions' totals
    tell which of them hold the wanted ranks; only those are ranked row by row.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    pairs = [
        (F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in numeric
    ]
    counts = (
        df.select(*_spread(pairs))
        .where("value is not null and not isnan(value)")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = counts.repartitionByRange("column", "value")
    placed = written(ranged.withColumn("part", F.spark_partition_id()), "value-counts")

    by_part = Window.partitionBy("column").orderBy("part")
    sizes = placed.groupBy("column", "part").agg(F.sum("n").alias("size"))
    offsets = sizes.withColumns(
        {
            "total": F.sum("size").over(Window.partitionBy("column")),
            "offset": F.sum("size").over(by_part) - F.col("size"),
        }
    )
    last = F.col("total") - 1
    lower = [F.floor(last * p) for p in points]
    upper = [F.least(k + 1, last) for k in lower]

    def holds(rank, start, length):
        return (rank >= start) & (rank < start + length)

    wanted = reduce(or_, [holds(k, F.col("offset"), F.col("size")) for k in lower + upper])
    within = Window.partitionBy("column", "part").orderBy("value")
    ranked = placed.join(offsets.where(wanted), ["column", "part"]).withColumn(
        "start", F.col("offset") + F.sum("n").over(within) - F.col("n")
    )

    def value_at(rank):
        return F.max(F.when(holds(rank, F.col("start"), F.col("n")), F.col("value")))

    ends = [
        c
        for i in range(len(points))
        for c in (value_at(lower[i]).alias(f"lo{i}"), value_at(upper[i]).alias(f"hi{i}"))
    ]
    found = ranked.groupBy("column", "total").agg(*ends)
    results = []
    for i, p in enumerate(points):
        part = last * p - lower[i]
        results.append((F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * part).alias(f"p{p * 100:g}"))
    return found.select("column", *results)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def schema_drift(spark: SparkSession, expected: T.StructType, actual: T.StructType) -> DataFrame:
    """Per column: ``same``, ``type_changed``, ``missing`` or ``added``."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}
    rows = []
    for name in [*want, *(n for n in have if n not in want)]:
        left, right = want.get(name), have.get(name)
        if left is None:
            status = "added"
        elif right is None:
            status = "missing"
        else:
            status = "same" if left == right else "type_changed"
        rows.append((name, left, right, status))
    return spark.createDataFrame(rows, DRIFT_SCHEMA)


def quality_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Row count, null rate and drift status per column, missing ones included."""
    drift = schema_drift(df.sparkSession, expected, df.schema)
    return drift.join(null_rates(df), "column", "left")
