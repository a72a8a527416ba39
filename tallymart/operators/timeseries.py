"""Monthly series operators: gap fill, changes, rolling band, overlay, forecasts.

A series has ``date`` (first of month), ``revenue`` and optional key columns.
It is an aggregate: a key has one row per month, so a window over one key is
bounded by the calendar, whatever the size of the data below.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.measures import clip_low, percent_change, ratio

ONE_MONTH = "interval 1 month"


def _ordered(keys: tuple[str, ...]):
    return Window.partitionBy(*keys).orderBy("date")


def _zero(df: DataFrame, column: str):
    return F.lit(0).cast(df.schema[column].dataType)


def month_calendar(series: DataFrame) -> DataFrame:
    """Every month from the first to the last one of the series."""
    bounds = series.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return bounds.select(
        F.explode(F.sequence("first", "last", F.expr(ONE_MONTH))).alias("date")
    )


def on_calendar(series: DataFrame, calendar: DataFrame, *keys: str) -> DataFrame:
    """One row per key and calendar month; months without a row have revenue 0.

    With keys the months reach each key as one array (a calendar has a row per
    month), so keys and months are paired without a cross join.  Pass stored tables.
    """
    revenue = F.coalesce("revenue", _zero(series, "revenue"))
    if keys:
        months = calendar.agg(F.array_sort(F.collect_set("date"))).scalar()
        calendar = series.select(*keys).distinct().withColumn("date", F.explode(months))
    same = [calendar["date"] == series["date"], *[calendar[k].eqNullSafe(series[k]) for k in keys]]
    return calendar.join(series, reduce(and_, same), "left").select(
        calendar["date"],
        F.year(calendar["date"]).alias("year"),
        F.month(calendar["date"]).alias("month"),
        *[calendar[k] for k in keys],
        revenue.alias("revenue"),
    )


def fill_months(series: DataFrame, *keys: str) -> DataFrame:
    """Add the missing months of each key, with revenue 0.

    Each row emits itself and the gap up to the key's next row, so one window
    on the key does it; there is no calendar to join per key.
    """
    following = F.lead("date").over(_ordered(keys))
    span = F.sequence(
        F.col("date"),
        F.coalesce(F.add_months(following, -1), F.col("date")),
        F.expr(ONE_MONTH),
    )
    zero = _zero(series, "revenue")
    own = F.coalesce("revenue", zero)
    spread = series.select(*keys, "date", own.alias("revenue"), span.alias("span"))
    return spread.select(
        *keys, F.col("date").alias("own_date"), "revenue", F.explode("span").alias("date")
    ).select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        *keys,
        F.when(F.col("date") == F.col("own_date"), F.col("revenue")).otherwise(zero).alias("revenue"),
    )


def with_changes(series: DataFrame, *keys: str) -> DataFrame:
    """Previous month, same month a year before, MoM %, YoY % and year to date.

    The lags count rows, so fill the months first.
    """
    order = _ordered(keys)
    year_so_far = (
        Window.partitionBy(*keys, F.year("date"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    lagged = series.withColumns(
        {
            "prev": F.lag("revenue", 1).over(order),
            "last_year": F.lag("revenue", 12).over(order),
            "ytd": F.sum("revenue").over(year_so_far),
        }
    )
    current = F.col("revenue")
    return lagged.withColumns(
        {
            "mom": percent_change(current, F.col("prev")),
            "yoy": percent_change(current, F.col("last_year")),
        }
    )


def rolling_band(
    series: DataFrame,
    *keys: str,
    window: int = 6,
    min_periods: int = 3,
    threshold: float = 2.0,
    exclude_current: bool = False,
) -> DataFrame:
    """Rolling mean and sample deviation, z-score, anomaly flag and band.

    By default the current month is part of its own window, which bounds the
    z-score; ``exclude_current`` judges a month against the ones before it.
    """
    last = -1 if exclude_current else 0
    frame = _ordered(keys).rowsBetween(last - window + 1, last)
    revenue = F.col("revenue").cast("double")
    enough = F.count("revenue").over(frame) >= min_periods
    rolled = series.withColumns(
        {
            "ma": F.when(enough, F.avg(revenue).over(frame)),
            "std": F.when(enough, F.stddev_samp(revenue).over(frame)),
        }
    )
    scored = rolled.withColumn("z", ratio(revenue - F.col("ma"), F.col("std")))
    return scored.withColumns(
        {
            "anomaly": F.coalesce(F.abs("z") >= threshold, F.lit(False)),
            "band_low": clip_low(F.col("ma") - F.col("std")),
            "band_high": F.col("ma") + F.col("std"),
        }
    )


def anomalies(banded: DataFrame) -> DataFrame:
    return banded.where(F.col("anomaly") & F.col("ma").isNotNull())


def last_months(series: DataFrame, n: int, *keys: str) -> DataFrame:
    """The last ``n`` rows of each key, numbered backwards in ``back`` from 1."""
    backwards = Window.partitionBy(*keys).orderBy(F.desc("date"))
    return series.withColumn("back", F.row_number().over(backwards)).where(F.col("back") <= n)


def overlay(series: DataFrame, span: int = 12) -> DataFrame:
    """The last ``span`` months beside the ``span`` before, by position from 0.

    Empty for a series of fewer than ``2 * span`` months.
    """
    tail = last_months(series, 2 * span)
    whole = F.count(F.lit(1)).over(Window.partitionBy()) == 2 * span
    label = F.when(F.col("back") <= span, f"Last {span}M").otherwise(f"Prev {span}M")
    return tail.withColumn("_whole", whole).where("_whole").select(
        label.alias("series"),
        ((2 * span - F.col("back")) % span).alias("pos"),
        "date",
        "revenue",
    )


def seasonal_naive(series: DataFrame, *keys: str, season: int = 12) -> DataFrame:
    """Forecast of the next ``season`` months: the value one season before."""
    return last_months(series, season, *keys).select(
        *keys, F.add_months("date", season).alias("date"), F.col("revenue").alias("forecast")
    )


def linear_trend(series: DataFrame, *keys: str) -> DataFrame:
    """Least-squares line over the month number, and its next month's value."""
    t = (F.year("date") * 12 + F.month("date")).cast("double")
    y = F.col("revenue").cast("double")
    fitted = series.groupBy(*keys).agg(
        F.regr_slope(y, t).alias("slope"),
        F.regr_intercept(y, t).alias("intercept"),
        F.max(t).alias("last_t"),
        F.add_months(F.max("date"), 1).alias("date"),
    )
    forecast = F.col("intercept") + F.col("slope") * (F.col("last_t") + 1)
    return fitted.select(*keys, "date", "slope", "intercept", forecast.alias("forecast"))
