"""KPI, insight and chart tables over gold series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.measures import money_label, percent_label
from tallymart.operators import timeseries as ts
from tallymart.operators.aggregates import latest_top, pareto, top_series
from tallymart.operators.schema import dimension_column


def _latest_row(series: DataFrame) -> DataFrame:
    return ts.with_changes(ts.fill_months(series)).orderBy(F.desc("date")).limit(1)


def kpi_card(series: DataFrame) -> DataFrame:
    """Latest revenue, MoM, YoY and year to date as labels, in one row."""
    return _latest_row(series).select(
        "date",
        money_label(F.col("revenue")).alias("revenue"),
        percent_label(F.col("mom")).alias("mom"),
        percent_label(F.col("yoy")).alias("yoy"),
        money_label(F.col("ytd")).alias("ytd"),
    )


# The sentence texts of this module are fixed values.


def _direction(change: Column, against: str) -> Column:
    verb = F.when(change >= 0, "increased").otherwise("decreased")
    sentence = F.format_string(f"Revenue %s %.1f%% vs {against}.", verb, F.abs(change))
    return F.when(change.isNotNull(), sentence)


def _contributors(by_dim: DataFrame, dim: str) -> DataFrame:
    """One sentence over the three largest values of the latest month."""
    label = F.format_string("%s (%s)", F.col(dim), money_label(F.col("revenue")))
    order = Window.orderBy(F.desc("revenue"), dim)
    top = latest_top(by_dim, dim, 3, regroup=True).select(
        F.row_number().over(order).alias("position"), label.alias("label")
    )
    listed = F.array_sort(F.collect_list(F.struct("position", "label")))
    return top.agg(F.array_join(F.transform(listed, lambda s: s["label"]), ", ").alias("names")).select(
        F.when(
            F.col("names") != "",
            F.concat(F.lit("Top contributors this month: "), "names", F.lit(".")),
        ).alias("sentence")
    )


def insights(
    series: DataFrame, by_dim: DataFrame | None = None, dim: str | None = None
) -> DataFrame:
    """Sentences about the latest month, numbered from 1; a default if none fits.

    ``dim`` defaults to the first column of ``by_dim`` that can be a dimension.
    """
    sentences = [_direction(F.col("mom"), "last month"), _direction(F.col("yoy"), "last year")]
    if by_dim is not None:
        sentences.append(_contributors(by_dim, dim or dimension_column(by_dim)).scalar())
    said = F.array_compact(F.array(*sentences))
    default = F.array(F.lit("No major changes detected."))
    return (
        _latest_row(series)
        .select(F.posexplode(F.when(F.size(said) > 0, said).otherwise(default)))
        .select((F.col("pos") + 1).alias("position"), F.col("col").alias("sentence"))
    )


def _panel(df: DataFrame, panel: str, name: Column | str, x: str, y: Column) -> DataFrame:
    label = F.lit(name) if isinstance(name, str) else name
    return df.select(
        F.lit(panel).alias("panel"),
        label.alias("series"),
        F.col(x).cast("string").alias("x"),
        y.cast("double").alias("y"),
    )


def dashboard_series(
    series: DataFrame,
    by_dim: DataFrame | None = None,
    dim: str | None = None,
    by_place: DataFrame | None = None,
    place: str = "country",
) -> DataFrame:
    """Every chart's points as (panel, series, x, y).

    Panels whose input is missing are left out.  Pass stored gold tables: each
    panel reads its input again.
    """
    banded = ts.rolling_band(ts.fill_months(series))
    paired = ts.overlay(ts.fill_months(series))
    panels = [
        _panel(banded, "trend", "Upper Band", "date", F.col("band_high")),
        _panel(banded, "trend", "Confidence Band", "date", F.col("band_low")),
        _panel(banded, "trend", "Revenue", "date", F.col("revenue")),
        _panel(ts.anomalies(banded), "trend", "Anomaly", "date", F.col("revenue")),
        _panel(
            paired,
            "trend",
            F.concat(F.col("series"), F.lit(" (Indexed)")),
            "pos",
            F.col("revenue"),
        ),
    ]
    if by_dim is not None:
        dim = dim or dimension_column(by_dim)
        ranked = pareto(by_dim, dim)
        panels += [
            _panel(ranked, "latest", "Revenue", dim, F.col("revenue")),
            _panel(ranked, "latest", "Pareto %", dim, F.col("cum_share") * 100),
            _panel(top_series(by_dim, dim), "share", F.col(dim), "date", F.col("revenue")),
        ]
    if by_place is not None:
        totals = by_place.groupBy(place).agg(F.sum("revenue").alias("revenue"))
        panels.append(_panel(totals, "places", "Revenue", place, F.col("revenue")))
    combined = panels[0]
    for panel in panels[1:]:
        combined = combined.unionByName(panel)
    return combined
