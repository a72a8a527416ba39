from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.functions import measures as M
from tallymart.functions import values as V
from tallymart.functions.naming import normalize_columns, normalize_names


def one(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_money(spark):
    good = [" $1,234.50 ", "₹12", "12 34", "€5", "£ 7.1", "-$3.25", "1e3"]
    assert one(spark, V.money, good) == [
        Decimal(x) for x in ("1234.5000", "12.0000", "1234.0000", "5.0000", "7.1000", "-3.2500", "1000.0000")
    ]
    junk = ["", "   ", "Sales5", "(5)", "NaN", "Infinity", "5d", "$", None, "1.2.3"]
    assert one(spark, V.money, junk) == [None] * len(junk)


def test_quantity(spark):
    assert one(spark, V.quantity, ["1,200", "3.0", "x", "", " 4 ", "3.5", None, "1 2s,3", "99999999999"]) == [
        1200, 3, None, None, 4, None, None, None, None,
    ]


def test_dates(spark):
    texts = ["2/5/2011", "2011-02-05", " 12/31/2012 ", "2011-02-05 00:00:00.000", "x", "13/45/2011", "", None]
    expected = [date(2011, 2, 5), date(2011, 2, 5), date(2012, 12, 31), date(2011, 2, 5)] + [None] * 4
    assert one(spark, V.parse_date, texts) == expected
    assert one(spark, lambda c: V.parse_date(c, ("dd.MM.yyyy",)), ["31.12.2012"]) == [date(2012, 12, 31)]
    numbers = ["32298", "2015", "20150102", "2015-01", "12-2015-01", "+2015-01-02"]
    assert one(spark, V.parse_date, numbers) == [None] * 6
    mixed = ("M/d/yyyy H:mm", "dd-MM-yyyy", "d-MMM-yyyy", "M/d/yy")
    spelt = ["1/1/2011 0:00", "31-07-2012", "5-Jan-2015", "2/5/11", "2011"]
    wanted = [date(2011, 1, 1), date(2012, 7, 31), date(2015, 1, 5), date(2011, 2, 5), None]
    assert one(spark, lambda c: V.parse_date(c, mixed), spelt) == wanted
    flipped = one(spark, lambda c: V.parse_date(c, ("yyyy-dd-MM",), iso_first=False), ["2012-03-04", "2012-01-31"])
    assert flipped == [date(2012, 4, 3), date(2012, 1, 31)]


def test_dimension_and_blank(spark):
    assert one(spark, V.dimension, ["  Office Supplies ", None]) == ["office supplies", None]
    assert one(spark, V.blank_to_null, ["", "  ", " a "]) == [None, None, "a"]


def test_month_helpers(spark):
    assert one(spark, V.month_start, [date(2011, 2, 5)], "date") == [date(2011, 2, 1)]
    assert one(spark, lambda c: V.month_date(c, F.lit("7")), ["2013"]) == [date(2013, 7, 1)]


def test_ratio_and_clip(spark):
    assert one(spark, lambda c: M.ratio(c, c), [2.0, 0.0, None], "double") == [1.0, None, None]
    assert one(spark, M.clip_low, [-1.0, 2.0, None], "double") == [0.0, 2.0, None]


def test_labels(spark):
    amounts = [None, 1309206.0, 773262.0, 999.6, -2500000.0, 0.0, 12.4]
    assert one(spark, M.money_label, amounts, "double") == [
        "-", "$1.31M", "$773.3K", "$1,000", "$-2.50M", "$0", "$12",
    ]
    assert one(spark, M.percent_label, [26.63, -3.0, 0.0, None], "double") == ["+26.6%", "-3.0%", "+0.0%", "-"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.decimals(min_value=0, max_value=10**9, places=4), min_size=1, max_size=30))
def test_money_reads_back_what_was_written(spark, amounts):
    texts = [f" ${x:,.4f} " for x in amounts]
    assert one(spark, V.money, texts) == amounts


@pytest.mark.parametrize(
    "mode, names, expected",
    [
        ("snake", [" Order Date", "Sales ($)", "a..b--c", "[x]/(y)", "记录数", "Sub-Category"],
         ["order_date", "sales_$", "a_b_c", "x_y", "记录数", "sub_category"]),
        ("strict", ["Order Date", "Disc.", "记录数", "Sub-Category"],
         ["order_date", "disc_", "_", "sub_category"]),
        ("lower", [" Order Date ", "YEAR"], ["order date", "year"]),
        ("snake", ["Order Date", "order.date", "ORDER-DATE", "order_date_2"],
         ["order_date", "order_date_2", "order_date_3", "order_date_2_2"]),
        ("snake", ["()", "a"], ["column_1", "a"]),
    ],
)
def test_names(mode, names, expected):
    assert normalize_names(names, mode) == expected


def test_normalize_columns_keeps_the_data(spark):
    df = normalize_columns(spark.createDataFrame([(1, 2)], ["Order.Date", "order date"]))
    assert df.columns == ["order_date", "order_date_2"]
    assert df.first() == (1, 2)
