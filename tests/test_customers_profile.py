from __future__ import annotations

from datetime import date

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators import customers, dedupe, profile

ORDERS = [
    ("c1", 1, date(2011, 1, 5), 10.0),
    ("c1", 1, date(2011, 1, 5), 20.0),
    ("c1", 2, date(2011, 2, 1), 30.0),
    ("c2", 3, date(2011, 1, 9), 5.0),
    ("c3", 4, date(2011, 12, 31), 8.0),
]
SCHEMA = "customer_id string, order_id int, order_date date, sales_clean double"


def test_lifetime_value(spark):
    row = customers.lifetime_value(spark.createDataFrame(ORDERS, SCHEMA)).where("customer_id = 'c1'").first()
    assert (row["revenue"], row["orders"], row["tenure_days"], row["avg_order_value"]) == (60.0, 2, 27, 30.0)


def test_churn(spark):
    last = customers.last_orders(spark.createDataFrame(ORDERS, SCHEMA))
    assert {r["customer_id"]: r["churned"] for r in customers.churn(last).collect()} == {
        "c1": True, "c2": True, "c3": False,
    }
    early = customers.churn(last.where("customer_id <> 'c3'"), as_of="2011-02-10", inactive_days=20)
    assert {r["customer_id"]: (r["recency_days"], r["churned"]) for r in early.collect()} == {
        "c1": (9, False), "c2": (32, True),
    }


def test_retention(spark):
    rows = customers.retention(spark.createDataFrame(ORDERS, SCHEMA)).orderBy("date").collect()
    assert [(r["active"], r["retained"], r["retention"]) for r in rows] == [(2, 1, 0.5), (1, 0, 0.0), (1, 0, 0.0)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "n int, s string")
    rows = {r["column"]: r for r in profile.profile(df).collect()}
    assert (rows["n"]["nulls"], rows["n"]["mean"], rows["n"]["min"], rows["n"]["max"]) == (1, 1.5, 1.0, 2.0)
    assert (rows["s"]["nulls"], rows["s"]["dtype"], rows["s"]["mean"]) == (2, "string", None)


def test_quartiles_are_within_their_rank_error(spark):
    n = 50_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("v"))
    row = profile.profile(df, accuracy=1000).first()
    for p, got in ((0.25, row["p25"]), (0.5, row["p50"]), (0.75, row["p75"])):
        assert abs(got - p * n) <= 2 * n / 1000


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60))
def test_exact_quantiles_against_pandas(spark, values):
    df = spark.createDataFrame([(v, 2.5) for v in values], "v int, w double").repartition(3)
    got = {r["column"]: r for r in profile.exact_quantiles(df, (0.1, 0.5, 0.75)).collect()}
    expected = pd.Series(values, dtype="float").dropna()
    assert tuple(got["w"])[1:] == (2.5, 2.5, 2.5)
    if expected.empty:
        assert "v" not in got
    else:
        assert tuple(got["v"])[1:] == pytest.approx(tuple(expected.quantile([0.1, 0.5, 0.75])))
        assert got["v"].__fields__ == ["column", "p10", "p50", "p75"]


def test_null_rates(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`a.b` int, c string")
    assert [tuple(r) for r in profile.null_rates(df).collect()] == [("a.b", 2, 1, 0.5), ("c", 2, 2, 1.0)]
    empty = profile.null_rates(df.limit(0)).first()
    assert (empty["rows"], empty["null_rate"]) == (0, None)


def test_drift_and_report(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c int")
    expected = T.StructType().add("a", "long").add("b", "string").add("z", "date")
    drift = {r["column"]: r["status"] for r in profile.schema_drift(spark, expected, df.schema).collect()}
    assert drift == {"a": "type_changed", "b": "same", "z": "missing", "c": "added"}
    report = {r["column"]: (r["status"], r["null_rate"]) for r in profile.quality_report(df, expected).collect()}
    assert report == {"a": ("type_changed", 0.0), "b": ("same", 0.0), "z": ("missing", None), "c": ("added", 1.0)}


def test_preview_is_ordered(spark):
    assert [r["id"] for r in profile.preview(spark.range(100), 3, "id").collect()] == [0, 1, 2]


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only"), (2, 1, "only")], "k int, v int, s string")
    assert dedupe.dedupe_exact(df).count() == 3
    kept = dedupe.dedupe_latest(df, ["k"], [F.desc("v"), "s"])
    assert {(r["k"], r["s"]) for r in kept.collect()} == {(1, "new"), (2, "only")}
    assert kept.columns == df.columns
