from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.operators import aggregates as agg
from tallymart.operators import timeseries as ts
from tallymart.plans import dashboard

SCHEMA = "date date, year int, month int, revenue double"
KEYED = "date date, year int, month int, k string, revenue double"


def month(i):
    return date(2011 + i // 12, i % 12 + 1, 1)


def series(spark, values):
    """``values`` maps a month number (0 = 2011-01) to revenue."""
    rows = [(month(i), month(i).year, month(i).month, v) for i, v in values.items()]
    return spark.createDataFrame(rows, SCHEMA)


def keyed(spark, values):
    rows = [(month(i), month(i).year, month(i).month, k, v) for (k, i), v in values.items()]
    return spark.createDataFrame(rows, KEYED)


def by_date(df, column):
    return {r["date"]: r[column] for r in df.collect()}


def test_fill(spark):
    filled = ts.fill_months(series(spark, {0: 1.0, 1: 2.0, 4: 5.0}))
    assert by_date(filled, "revenue") == {month(0): 1.0, month(1): 2.0, month(2): 0.0, month(3): 0.0, month(4): 5.0}
    assert by_date(filled, "month")[month(3)] == 4


def test_fill_keeps_decimals_and_null_is_zero(spark):
    df = spark.createDataFrame([(month(0), Decimal("1.5000")), (month(2), None)], "date date, revenue decimal(38,4)")
    filled = ts.fill_months(df)
    assert filled.schema["revenue"].dataType.simpleString() == "decimal(38,4)"
    assert by_date(filled, "revenue") == {month(0): Decimal("1.5"), month(1): 0, month(2): 0}


def test_fill_per_key_stays_in_each_keys_range(spark):
    filled = ts.fill_months(keyed(spark, {("a", 0): 1.0, ("a", 2): 3.0, ("b", 5): 4.0}), "k")
    got = {(r["k"], r["date"]): r["revenue"] for r in filled.collect()}
    assert got == {("a", month(0)): 1.0, ("a", month(1)): 0.0, ("a", month(2)): 3.0, ("b", month(5)): 4.0}


@settings(max_examples=15, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1, max_size=12))
def test_fill_equals_the_calendar_join(spark, months):
    df = series(spark, {i: float(i + 1) for i in months})
    joined = ts.on_calendar(df, ts.month_calendar(df))
    assert by_date(ts.fill_months(df), "revenue") == by_date(joined, "revenue")
    assert len(by_date(joined, "revenue")) == max(months) - min(months) + 1


def test_changes(spark):
    df = series(spark, {i: float(i) for i in range(14)})
    changed = ts.with_changes(df)
    mom, yoy, ytd = (by_date(changed, c) for c in ("mom", "yoy", "ytd"))
    assert mom[month(0)] is None and mom[month(1)] is None and mom[month(2)] == 100.0
    assert yoy[month(12)] is None and yoy[month(13)] == 1200.0
    assert ytd[month(11)] == 66.0 and ytd[month(13)] == 25.0


def test_changes_of_a_zero_month(spark):
    changed = ts.with_changes(ts.fill_months(series(spark, {0: 5.0, 2: 6.0})))
    assert by_date(changed, "mom") == {month(0): None, month(1): -100.0, month(2): None}


def test_two_points_have_no_band(spark):
    for r in ts.rolling_band(series(spark, {0: 1.0, 1: 2.0})).collect():
        assert (r["ma"], r["std"], r["z"], r["band_low"], r["band_high"], r["anomaly"]) == (None,) * 5 + (False,)


def test_flat_history_has_no_score(spark):
    rows = ts.rolling_band(series(spark, {i: 2.0 for i in range(5)})).collect()
    assert all(r["z"] is None and not r["anomaly"] for r in rows)


def test_band_is_clipped_at_zero(spark):
    banded = ts.rolling_band(series(spark, {0: 0.0, 1: 0.0, 2: 90.0}))
    assert by_date(banded, "band_low")[month(2)] == 0.0


def test_exclude_current_sees_a_jump(spark):
    df = series(spark, {i: 10.0 + i % 2 for i in range(8)} | {8: 100.0})
    assert ts.anomalies(ts.rolling_band(df)).count() <= 1
    flagged = ts.anomalies(ts.rolling_band(df, exclude_current=True)).collect()
    assert [r["date"] for r in flagged] == [month(8)]


def test_overlay_needs_two_spans(spark):
    assert ts.overlay(series(spark, {i: 1.0 for i in range(23)})).count() == 0
    assert ts.overlay(series(spark, {i: 1.0 for i in range(24)})).count() == 24


def test_last_months_per_key(spark):
    df = keyed(spark, {("a", i): float(i) for i in range(5)} | {("b", 0): 9.0})
    got = {(r["k"], r["back"]): r["revenue"] for r in ts.last_months(df, 2, "k").collect()}
    assert got == {("a", 1): 4.0, ("a", 2): 3.0, ("b", 1): 9.0}


def test_forecasts(spark):
    df = series(spark, {i: 10.0 + 2.0 * i for i in range(24)})
    naive = by_date(ts.seasonal_naive(df), "forecast")
    assert naive[month(24)] == 34.0 and len(naive) == 12
    line = ts.linear_trend(df).first()
    assert line["slope"] == pytest.approx(2.0) and line["date"] == month(24)
    assert line["forecast"] == pytest.approx(58.0)


def test_pareto_ties_take_key_order(spark):
    df = keyed(spark, {("b", 0): 5.0, ("a", 0): 5.0, ("c", 0): 1.0})
    shares = {r["k"]: r["cum_share"] for r in agg.pareto(df, "k").collect()}
    assert shares == {"a": 5 / 11, "b": 10 / 11, "c": 1.0}


def test_pareto_share_is_of_the_whole_month(spark):
    df = keyed(spark, {(f"k{i:02d}", 0): 1.0 for i in range(20)})
    rows = agg.pareto(df, "k", n=15).collect()
    assert len(rows) == 15 and max(r["cum_share"] for r in rows) == 0.75


def test_latest_top_ignores_older_months(spark):
    df = keyed(spark, {("a", 0): 99.0, ("b", 1): 1.0, ("c", 1): 2.0})
    assert {r["k"] for r in agg.latest_top(df, "k", 10).collect()} == {"b", "c"}
    assert {r["k"] for r in agg.latest_totals(df, "k").collect()} == {"b", "c"}


def test_pivots(spark):
    df = keyed(spark, {("a", 0): 1.0, ("b", 0): 5.0, ("a", 1): 2.0, ("c", 2): 0.5})
    wide = agg.pivot_months(df, "k", ["a", "b"]).orderBy("date").collect()
    assert [tuple(r)[1:] for r in wide] == [(1.0, 5.0, 0.0), (2.0, 0.0, 0.0), (0.0, 0.0, 0.5)]
    top = agg.pivot_top(df, "k", 2).orderBy("date").collect()
    assert [tuple(r)[1:] for r in top] == [(5.0, 1.0), (0.0, 2.0), (0.0, 0.0)]
    long = agg.top_series(df, "k", 2)
    assert long.count() == 6 and long.where("rank = 1 and k = 'b'").count() == 3


def test_pivots_lose_no_key(spark):
    df = keyed(spark, {("a", 0): 5.0, (None, 0): 9.0, ("b", 0): 3.0, ("c", 1): 1.0})
    wide = agg.pivot_months(df, "k", ["a"]).orderBy("date").collect()
    assert [tuple(r)[1:] for r in wide] == [(5.0, 12.0), (0.0, 1.0)]
    assert [tuple(r)[1:] for r in agg.pivot_occurring(df, "k").orderBy("date").collect()] == [(5.0, 3.0, 0.0, 9.0), (0.0, 0.0, 1.0, 0.0)]
    assert [tuple(r)[1:] for r in agg.pivot_top(df, "k", 2).orderBy("date").collect()] == [(9.0, 5.0), (0.0, 0.0)]
    assert agg.top_series(df, "k", 2).where("rank = 1 and k is null and revenue = 9").count() == 1
    with pytest.raises(ValueError):
        agg.pivot_occurring(df, "k", most=2)
    with pytest.raises(ValueError):
        agg.pivot_months(df, "k", ["other"])


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0)], "k string, sales_clean double")
    shares = agg.revenue_share(agg.revenue_by(df, "k"))
    assert {r["k"]: r["share"] for r in shares.collect()} == {"a": 0.25, "b": 0.75}


def test_totals_with_nothing_sold(spark):
    df = spark.createDataFrame([], "sales_clean double, profit_clean double")
    assert tuple(agg.kpi_totals(df).first()) == (None, None, None)


def test_insights_default(spark):
    said = dashboard.insights(series(spark, {0: 5.0})).collect()
    assert [tuple(r) for r in said] == [(1, "No major changes detected.")]


def test_card_of_one_month(spark):
    assert tuple(dashboard.kpi_card(series(spark, {0: 5.0})).first()) == (month(0), "$5", "-", "-", "$5")


def test_total_equals_the_sum_of_its_parts(spark):
    rows = [(2011, m, c, Decimal(m * i)) for m in range(1, 13) for i, c in enumerate("xyz", 1)]
    gold = spark.createDataFrame(rows, "year int, month int, category string, total_sales decimal(38,4)")
    totals = {(r["year"], r["month"]): r["total_sales"] for r in agg.roll_up(gold).collect()}
    assert totals == {(2011, m): Decimal(6 * m) for m in range(1, 13)}
    assert agg.to_series(gold, "category").columns == ["date", "year", "month", "category", "revenue"]


def test_margin_of_a_free_item(spark):
    df = spark.createDataFrame([(0.0, 1.0), (4.0, 1.0)], "sales_clean double, profit_clean double")
    assert [r["profit_margin"] for r in agg.with_margin(df).orderBy("sales_clean").collect()] == [None, 0.25]


def test_top_by_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k, 1.0) for k in "cab"], "k string, sales_clean double")
    assert {r["k"] for r in agg.top_by(df, "k", 2).collect()} == {"a", "b"}
    assert df.groupBy().agg(F.count("k")).first()[0] == 3
