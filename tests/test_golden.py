"""Published monthly sales of a real run, and the dashboard values made from them."""

from __future__ import annotations

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymart.operators import timeseries as ts
from tallymart.operators.aggregates import latest_top, pareto, roll_up, to_series, top_series
from tallymart.plans import dashboard

# Monthly sales from 2011-01 on, one line per year.
SALES = {
    "office supplies": (
        212494, 59020, 150559, 80439, 82048, 65127, 257663, 128943, 330825, 238292, 316328, 228709,
        84347, 96624, 206331, 110626, 249237, 220515, 192937, 129692, 489281, 99093, 394239, 290307,
        64990, 120883, 213547, 197953, 217673, 296782, 251402, 227164, 546183, 361381, 394727, 454849,
        186282, 164561, 224816, 152072, 312099, 507682, 181931, 306736, 492365, 402098, 492711, 773262,
    ),
    "furniture": (
        34459, 70863, 44782, 31345, 44981, 119447, 31383, 102614, 95027, 77416, 122911, 166294,
        42494, 37902, 55084, 54111, 97371, 81478, 41494, 159903, 95933, 84826, 155161, 96848,
        115686, 59121, 65320, 93767, 107049, 187654, 71865, 112309, 240859, 127805, 122219, 175223,
        101897, 57702, 126585, 143327, 137924, 136157, 148976, 163529, 249592, 165021, 318577, 354846,
    ),
    "technology": (
        30911, 38231, 66554, 70539, 55662, 71694, 42770, 80900, 92255, 73427, 113418, 122905,
        46208, 38122, 54277, 62468, 84366, 98857, 57404, 121240, 114379, 144273, 103211, 134200,
        52401, 56569, 71263, 106517, 111378, 169778, 87785, 154226, 138162, 126700, 140452, 134327,
        94810, 71952, 95828, 90853, 92120, 145360, 168716, 174897, 171006, 249166, 222587, 181098,
    ),
}

# Band of the third and of the last month, Pareto shares, labels.
BAND = {
    date(2011, 3, 1): (176663.2776375744, 295252.0556957589),
    date(2014, 12, 1): (582389.0966941966, 1156648.9033058034),
}
PARETO = [
    ("office supplies", 773262.0, 59.06343233990678),
    ("furniture", 354846.0, 86.16734112125975),
    ("technology", 181098.0, 100.0),
]
CARD = (date(2014, 12, 1), "$1.31M", "+26.6%", "+71.3%", "$8.06M")
SENTENCES = [
    "Revenue increased 26.6% vs last month.",
    "Revenue increased 71.3% vs last year.",
    "Top contributors this month: office supplies ($773.3K), furniture ($354.8K), technology ($181.1K).",
]


@pytest.fixture(scope="module")
def by_category(spark):
    rows = [
        (2011 + i // 12, i % 12 + 1, category, float(amount))
        for category, amounts in SALES.items()
        for i, amount in enumerate(amounts)
    ]
    return spark.createDataFrame(rows, "year int, month int, category string, total_sales double").cache()


@pytest.fixture(scope="module")
def total(by_category):
    return to_series(roll_up(by_category)).cache()


@pytest.fixture(scope="module")
def categories(by_category):
    return to_series(by_category, "category").cache()


def test_band(total):
    got = {r["date"]: r for r in ts.rolling_band(ts.fill_months(total)).collect()}
    assert len(got) == 48
    for month, (low, high) in BAND.items():
        assert got[month]["band_low"] == pytest.approx(low, abs=1e-6)
        assert got[month]["band_high"] == pytest.approx(high, abs=1e-6)
    for month in (date(2011, 1, 1), date(2011, 2, 1)):
        assert got[month]["ma"] is None and got[month]["band_low"] is None
    assert max(abs(r["z"]) for r in got.values() if r["z"] is not None) == pytest.approx(1.815, abs=1e-3)


def test_band_against_pandas(total):
    got = ts.rolling_band(ts.fill_months(total)).orderBy("date").toPandas()
    rolling = got["revenue"].rolling(6, min_periods=3)
    pd.testing.assert_series_equal(got["ma"], rolling.mean(), check_names=False, rtol=1e-9)
    pd.testing.assert_series_equal(got["std"], rolling.std(), check_names=False, rtol=1e-9)


def test_no_anomaly(total):
    assert ts.anomalies(ts.rolling_band(ts.fill_months(total))).count() == 0


def test_pareto(categories):
    rows = pareto(categories, "category").orderBy(F.desc("revenue")).collect()
    assert [(r["category"], r["revenue"]) for r in rows] == [(n, x) for n, x, _ in PARETO]
    assert [r["cum_share"] * 100 for r in rows] == pytest.approx([s for *_, s in PARETO])


def test_card_and_sentences(total, categories):
    assert tuple(dashboard.kpi_card(total).first()) == CARD
    said = dashboard.insights(total, categories).orderBy("position").collect()
    assert [r["sentence"] for r in said] == SENTENCES


def test_overlay_names_the_later_year_last(total):
    rows = ts.overlay(ts.fill_months(total)).collect()
    years = {(r["series"], r["date"].year) for r in rows}
    assert years == {("Last 12M", 2014), ("Prev 12M", 2013)}
    assert all(r["pos"] == r["date"].month - 1 for r in rows)
    first = {r["series"]: r["revenue"] for r in rows if r["pos"] == 0}
    assert first == {"Last 12M": 382989.0, "Prev 12M": 233077.0}


def test_stacked_series(categories):
    rows = top_series(categories, "category").orderBy("rank", "date").collect()
    assert len(rows) == 144
    assert [r["revenue"] for r in rows if r["category"] == "technology"] == list(SALES["technology"])


def test_all_panels(total, categories):
    points = dashboard.dashboard_series(total, categories)
    counts = {(r["panel"], r["series"]): r["count"] for r in points.groupBy("panel", "series").count().collect()}
    assert counts == {
        ("trend", "Upper Band"): 48, ("trend", "Confidence Band"): 48, ("trend", "Revenue"): 48,
        ("trend", "Last 12M (Indexed)"): 12, ("trend", "Prev 12M (Indexed)"): 12,
        ("latest", "Revenue"): 3, ("latest", "Pareto %"): 3,
        ("share", "office supplies"): 48, ("share", "furniture"): 48, ("share", "technology"): 48,
    }


def test_panels_without_categories(total):
    points = dashboard.dashboard_series(total)
    assert {r["panel"] for r in points.select("panel").distinct().collect()} == {"trend"}


def test_latest_top(categories):
    rows = latest_top(categories, "category", 2).collect()
    assert sorted(r["category"] for r in rows) == ["furniture", "office supplies"]
