from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymart.contract import ORDER_FILE_COLUMNS, OrderContract
from tallymart.functions.naming import normalize_names
from tallymart.operators import cleaning, quality
from tallymart.operators.schema import (
    MissingColumnsError,
    canonical,
    dimension_column,
    find_column,
    resolve_columns,
)
from tallymart.sources.readers import CORRUPT

RAW = [
    ("1", "2/5/2011", "$10.00", " A "),
    ("2", "2011-02-06", "0", "b"),
    ("3", "x", "5", "b"),
    ("3", "x", "5", "b"),
    ("4", "2/7/2011", None, "c"),
    ("5", None, "NaN", "c"),
    ("6", "2/8/2011", "7.5", None),
]


def orders(spark):
    return spark.createDataFrame(RAW, "`Order ID` string, `Order Date` string, Revenue string, Category string")


def test_good_and_bad_are_the_whole_input(spark):
    df = cleaning.clean_orders(orders(spark))
    good, bad = quality.good_rows(df), quality.rejected_rows(df)
    assert Counter(good.collect()) + Counter(bad.collect()) == Counter(df.collect())
    assert good.count() == 2 and bad.count() == 5
    assert Counter(quality.except_all(df, good).collect()) == Counter(bad.collect())


def test_reasons(spark):
    classified = quality.classify(cleaning.clean_orders(orders(spark)))
    reasons = {(r["order_id"], tuple(r[quality.REASONS])) for r in quality.quarantined(classified).collect()}
    assert reasons == {
        ("2", ("non_positive_sales",)),
        ("3", ("missing_order_date",)),
        ("4", ("missing_sales",)),
        ("5", ("missing_order_date", "missing_sales")),
    }
    assert quality.accepted(classified).count() == 2
    counts = {r["reason"]: r["rows"] for r in quality.reason_counts(classified).collect()}
    assert counts == {"non_positive_sales": 1, "missing_order_date": 3, "missing_sales": 2}


def test_wide_rows_are_rejects(spark):
    df = cleaning.clean_orders(orders(spark)).withColumn(
        CORRUPT, F.when(F.col("order_id") == "1", F.lit("1,2,3"))
    )
    bad = quality.quarantined(quality.classify(df))
    assert bad.where(F.array_contains(quality.REASONS, "corrupt_record")).count() == 1


def test_metrics(spark):
    classified = quality.classify(cleaning.clean_orders(orders(spark)))
    metrics = quality.collect_metrics(classified)
    assert (metrics.row_in, metrics.row_good, metrics.row_bad) == (7, 2, 5)
    empty = quality.collect_metrics(classified.limit(0))
    assert (empty.row_in, empty.bad_fraction) == (0, 0.0)


@pytest.mark.parametrize("row_in, row_good, passes", [(100, 95, True), (1000, 949, False), (0, 0, True)])
def test_gate(row_in, row_good, passes):
    metrics = quality.RunMetrics(row_in, row_good)
    if passes:
        quality.check_gate(metrics)
    else:
        with pytest.raises(quality.QualityGateError):
            quality.check_gate(metrics)


def test_columns_are_found_whatever_their_case(spark):
    df = spark.createDataFrame([("a", "b")], "QTY string, Amount string")
    assert find_column(df, ("quantity", "qty")) == "QTY"
    assert find_column(df, ("profit",)) is None


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "order_date string")
    with pytest.raises(MissingColumnsError, match="sales.*order_date"):
        resolve_columns(df, OrderContract())


def test_first_candidate_wins(spark):
    df = spark.createDataFrame([("d", "1", "2", "9")], "orderdate string, amount string, revenue string, qty string")
    assert canonical(df, OrderContract()).columns == ["order_date", "amount", "sales", "quantity"]


def test_silver_keeps_the_source_year(spark):
    df = spark.createDataFrame([("2/5/2011", "3", "1999", " X ")], "order_date string, sales string, year string, category string")
    row = cleaning.silver_columns(cleaning.clean_orders(df)).first()
    assert (row["src_year"], row["year"], row["month"], row["category"]) == ("1999", 2011, 2, "x")


def test_optional_columns_may_be_absent(spark):
    df = cleaning.clean_orders(spark.createDataFrame([("2/5/2011", "3")], "order_date string, sales string"))
    assert df.columns == ["order_date", "sales", "sales_clean"]


def test_dimension_column(spark):
    assert dimension_column(spark.createDataFrame([(1, 2, "x", 3.0)], "year int, month int, segment string, total_sales double")) == "segment"
    assert dimension_column(spark.createDataFrame([(1, 2, 3.0)], "year int, month int, total_sales double")) is None


def test_order_file_names_are_already_normal():
    assert normalize_names(list(ORDER_FILE_COLUMNS)) == list(ORDER_FILE_COLUMNS)
