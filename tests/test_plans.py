"""The physical plans operators are meant to have."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymart.operators import aggregates as agg
from tallymart.operators import cleaning, customers, dedupe, profile, quality
from tallymart.operators import timeseries as ts
from tallymart.session import written
from tallymart.sources import writers
from tallymart.sources.star import good_fact, order_fact, retail_fact, table


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return text.count("FileScan")


@pytest.fixture(scope="module")
def cleaned(spark, sf_dir):
    from tallymart.sources.messy import messy_bronze

    return written(cleaning.clean_orders(messy_bronze(spark, sf_dir)), "plan")


def test_rejects_need_no_shuffle(cleaned):
    text = plan(quality.rejected_rows(cleaned))
    assert "Exchange" not in text and scans(text) == 1
    assert "Exchange" in plan(quality.except_all(cleaned, quality.good_rows(cleaned)))


def test_good_rows_reach_the_scan(cleaned):
    text = plan(quality.good_rows(cleaned).select("order_id"))
    assert "PushedFilters: [IsNotNull(order_date), IsNotNull(sales_clean), GreaterThan(sales_clean,0.0000)]" in text
    assert "ReadSchema: struct<order_id:string,order_date:date,sales_clean:decimal(18,4)>" in text


def test_metrics_are_one_pass(cleaned):
    text = plan(quality.quality_metrics(cleaned, quality.is_good()))
    assert scans(text) == 1 and "partial_count" in text


def test_profile_is_one_pass(spark, sf_dir):
    text = plan(profile.profile(table(spark, sf_dir, "lineitem")))
    assert scans(text) == 1


@pytest.mark.parametrize("dims, tables", [((), 2), (("category",), 3), (("segment",), 3), (("country",), 4), (("category", "region"), 6)])
def test_fact_joins_what_it_needs(spark, sf_dir, dims, tables):
    df = agg.monthly_revenue(good_fact(spark, sf_dir, *dims), *dims)
    text = plan(df)
    assert scans(text) == tables
    assert "partial_sum" in text


def test_fact_rejects_unknown_dimensions(spark, sf_dir):
    with pytest.raises(ValueError, match="colour"):
        retail_fact(spark, sf_dir, "colour")


def test_lines_are_summed_per_order_before_the_join(spark, sf_dir):
    text = plan(customers.lifetime_value(order_fact(spark, sf_dir)))
    below = text[text.index("Join"):]
    assert "HashAggregate(keys=[l_orderkey" in below and "partial_sum(sales_clean" in below
    with pytest.raises(ValueError, match="category"):
        order_fact(spark, sf_dir, "category")


def test_order_grain_keeps_the_totals(spark, sf_dir):
    by_order = agg.revenue_by(order_fact(spark, sf_dir, "segment", "region"), "segment", "region")
    by_line = agg.revenue_by(good_fact(spark, sf_dir, "segment", "region"), "segment", "region")
    assert by_order.exceptAll(by_line).count() == 0 and by_order.count() == by_line.count()


def test_fact_scan_is_pruned(spark, sf_dir):
    text = plan(agg.monthly_revenue(good_fact(spark, sf_dir)))
    assert "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_series_windows_come_after_the_aggregate(spark, sf_dir):
    series = agg.to_series(agg.monthly_revenue(good_fact(spark, sf_dir)))
    assert "TakeOrderedAndProject" in plan(ts.overlay(series))
    for df in (ts.rolling_band(ts.fill_months(series)), ts.with_changes(ts.fill_months(series))):
        text = plan(df)
        single = text.rindex("Exchange SinglePartition")
        assert text.index("HashAggregate", single) < text.index("partial_sum", single)
        assert "Window" not in text[single:]


def test_keyed_windows_share_one_shuffle(spark, sf_dir):
    gold = written(agg.monthly_revenue(good_fact(spark, sf_dir, "category"), "category"), "gold")
    series = agg.to_series(gold, "category")
    text = plan(ts.rolling_band(ts.fill_months(series, "category"), "category"))
    assert text.count("Exchange") == 1 and "hashpartitioning(category" in text


def test_pareto_reads_its_series_once(spark, sf_dir):
    text = plan(agg.pareto(agg.to_series(agg.monthly_revenue(good_fact(spark, sf_dir, "category"), "category"), "category"), "category"))
    assert scans(text) == 3 and "TakeOrderedAndProject" in text


def test_latest_top_reads_its_series_once(spark, sf_dir):
    series = agg.to_series(agg.monthly_revenue(good_fact(spark, sf_dir, "category"), "category"), "category")
    text = plan(agg.latest_top(series, "category", 3))
    assert scans(text) == 3 and "TakeOrderedAndProject" in text


def test_top_k_is_bounded(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(agg.top_by(good_fact(spark, sf_dir), "customer_id", 10))


def test_dedupe_limits_each_task_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    text = plan(dedupe.dedupe_latest(lines, ["l_orderkey"], [F.desc("l_shipdate"), "l_partkey"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_retention_groups_before_it_windows(spark, sf_dir):
    text = plan(customers.retention(good_fact(spark, sf_dir)))
    below = text[text.index("Window"):]
    assert below.count("HashAggregate(keys=[customer_id") == 2


def test_a_hot_month_is_split_over_files(spark, tmp_path):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "100KB")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            "id", F.lit(2011).alias("year"), F.when(F.col("id") < 50, 2).otherwise(1).alias("month")
        )
        writers.write_silver(rows, str(tmp_path / "silver"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = list(Path(tmp_path / "silver" / "year=2011" / "month=1").glob("*.parquet"))
    cold = list(Path(tmp_path / "silver" / "year=2011" / "month=2").glob("*.parquet"))
    assert len(hot) > 2 and len(cold) == 1
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 200_000
