"""Revenue aggregates over silver rows or over a gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import values as V
from tallymart.functions.measures import ratio


def monthly_revenue(df: DataFrame, *dims: str, amount: str = "sales_clean") -> DataFrame:
    """Sales per (year, month) and dimension."""
    return df.groupBy("year", "month", *dims).agg(F.sum(amount).alias("total_sales"))


def roll_up(gold: DataFrame, *dims: str) -> DataFrame:
    """A gold table at fewer dimensions.  Decimal sums make this exact."""
    return monthly_revenue(gold, *dims, amount="total_sales")


def revenue_by_month_date(
    df: DataFrame, date: str = "order_date", amount: str = "sales_clean"
) -> DataFrame:
    """Sales per first day of month."""
    month = V.month_start(F.col(date)).alias("month")
    return df.groupBy(month).agg(F.sum(amount).alias("sales"))


def to_series(gold: DataFrame, *dims: str) -> DataFrame:
    """A gold table as a series: date, year, month, dimensions, revenue."""
    return gold.select(
        V.month_date(F.col("year"), F.col("month")).alias("date"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        *dims,
        F.col("total_sales").alias("revenue"),
    )


def revenue_by(df: DataFrame, *dims: str, amount: str = "sales_clean") -> DataFrame:
    """All-time sales per dimension value."""
    return df.groupBy(*dims).agg(F.sum(amount).alias("revenue"))


def largest(df: DataFrame, n: int, measure: str, *keys: str) -> DataFrame:
    """The ``n`` largest rows; ``keys`` decide between equal ones."""
    return df.orderBy(F.desc(measure), *keys).limit(n)


def top_by(df: DataFrame, dim: str, n: int, amount: str = "sales_clean") -> DataFrame:
    return largest(revenue_by(df, dim, amount=amount), n, "revenue", dim)


def revenue_share(by_dim: DataFrame) -> DataFrame:
    """Share of all revenue for each row of a ``revenue_by`` table.

    The table is read twice, once for its total: pass a stored one.
    """
    total = by_dim.select(F.sum("revenue")).scalar()
    return by_dim.withColumn("share", ratio(F.col("revenue"), total))


def kpi_totals(
    df: DataFrame, amount: str = "sales_clean", profit: str = "profit_clean"
) -> DataFrame:
    """Total sales, total profit and margin in one row."""
    sales, gain = F.sum(amount), F.sum(profit)
    return df.agg(
        sales.alias("total_sales"),
        gain.alias("total_profit"),
        ratio(gain, sales).alias("profit_margin"),
    )


def with_margin(
    df: DataFrame, amount: str = "sales_clean", profit: str = "profit_clean"
) -> DataFrame:
    return df.withColumn("profit_margin", ratio(F.col(profit), F.col(amount)))


def latest_top(series: DataFrame, dim: str, n: int, regroup: bool = False) -> DataFrame:
    """The ``n`` largest values of the latest month.

    Ordering by date first puts the latest month on top, so a bounded top-k
    finds it without a second pass for the latest date; rows of earlier months
    can only fill up a short list, and the window over at most ``n`` rows drops
    them again.
    """
    if regroup:
        series = series.groupBy("date", dim).agg(F.sum("revenue").alias("revenue"))
    head = series.orderBy(F.desc("date"), F.desc("revenue"), dim).limit(n)
    return _only_latest(head).select("date", dim, "revenue")


def _only_latest(head: DataFrame) -> DataFrame:
    return head.withColumn("_latest", F.max("date").over(Window.partitionBy())).where(
        F.col("date") == F.col("_latest")
    ).drop("_latest")


def latest_totals(series: DataFrame, dim: str) -> DataFrame:
    """Every value of the latest month, re-grouped.

    Reads the series twice, the first time for its last date: pass a stored one.
    """
    totals = series.groupBy("date", dim).agg(F.sum("revenue").alias("revenue"))
    return totals.where(F.col("date") == totals.select(F.max("date")).scalar())


def pareto(series: DataFrame, dim: str, n: int = 15) -> DataFrame:
    """Running share of the latest month's revenue, largest value first.

    The share is against the whole month; the list is cut to ``n`` afterwards.
    Grouping sets put each month's total beside its values, so the top-k below
    keeps the latest total and its ``n`` largest values, and only those rows
    are ever ordered in one place.
    """
    revenue = F.sum("revenue").alias("revenue")
    sums = series.groupingSets([["date", dim], ["date"]], "date", dim).agg(
        revenue, F.grouping(dim).alias("_is_total")
    )
    head = sums.orderBy(F.desc("date"), F.desc("_is_total"), F.desc("revenue"), dim).limit(n + 1)
    latest = _only_latest(head)
    running = Window.orderBy("_is_total", F.desc("revenue"), dim).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.max(F.when(F.col("_is_total") == 1, F.col("revenue"))).over(Window.partitionBy())
    shared = latest.withColumn("cum_share", ratio(F.sum("revenue").over(running), total))
    return shared.where(F.col("_is_total") == 0).select("date", dim, "revenue", "cum_share")


def ranked_values(series: DataFrame, dim: str, n: int = 8) -> DataFrame:
    """The ``n`` dimension values with the largest revenue, numbered from 1."""
    head = largest(revenue_by(series, dim, amount="revenue"), n, "revenue", dim)
    order = Window.orderBy(F.desc("revenue"), dim)
    return head.select(dim, F.row_number().over(order).alias("rank"))


def pivot_months(
    series: DataFrame, dim: str, values: list, fill: float | None = 0, rest: str = "other"
) -> DataFrame:
    """One row per month, one summed column per listed value, and ``rest`` for all others.

    Values are named by the caller, so no job runs to discover them.  The rest
    holds unlisted and NULL keys: the columns of a row always add up to the month's total.
    """
    if rest in map(str, values):
        raise ValueError(f"{rest!r} is a value; name the rest column otherwise")
    key = F.col(dim)
    listed = F.coalesce(key.isin(list(values)), F.lit(False)) if values else F.lit(False)
    tests = {str(v): key == v for v in values} | {rest: ~listed}
    sums = {name: F.sum(F.when(test, F.col("revenue"))) for name, test in tests.items()}
    filled = {n: c if fill is None else F.coalesce(c, F.lit(fill)) for n, c in sums.items()}
    return series.groupBy("date").agg(*[c.alias(n) for n, c in filled.items()])


def pivot_occurring(series: DataFrame, dim: str, most: int = 1_000) -> DataFrame:
    """``pivot_months`` over the values that occur.

    Reads the series twice, the first time for its values: pass a stored one.
    A key with more than ``most`` values is an error, never a cut list: such a
    series stays in its long form.
    """
    found = series.select(dim).where(F.col(dim).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{dim} has more than {most} values; keep the long form")
    return pivot_months(series, dim, sorted(r[0] for r in found))


def pivot_top(series: DataFrame, dim: str, n: int = 8) -> DataFrame:
    """Months x the ``n`` largest values, as columns ``rank_1`` .. ``rank_n``.

    The ranking runs first and the pivot is over ranks, so only the kept values
    are pivoted and no value list travels through the driver.  Months in which
    none of them sold stay, with zeros.  Reads the series twice: pass a stored
    one.  A NULL key that ranks has its column like any other.
    """
    ranks = ranked_values(series, dim, n).withColumnRenamed(dim, "_value")
    ranked = series.join(ranks, F.col(dim).eqNullSafe(F.col("_value")), "left")
    columns = [
        F.coalesce(F.sum(F.when(F.col("rank") == k, F.col("revenue"))), F.lit(0)).alias(f"rank_{k}")
        for k in range(1, n + 1)
    ]
    return ranked.groupBy("date").agg(*columns)


def top_series(series: DataFrame, dim: str, n: int = 8) -> DataFrame:
    """``pivot_top`` in long form with the value names: date, rank, dim, revenue."""
    wide = pivot_top(series, dim, n)
    stacked = wide.unpivot(
        "date", [f"rank_{k}" for k in range(1, n + 1)], "rank", "revenue"
    ).withColumn("rank", F.substring_index("rank", "_", -1).cast("int"))
    return stacked.join(ranked_values(series, dim, n), "rank").select("date", "rank", dim, "revenue")
