"""What keeps the bytes written and shuffled by the ingest queries low, with the same rows."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallymart import registry
from tallymart.operators.cleaning import clean_orders, silver_columns
from tallymart.operators.dedupe import dedupe_latest
from tallymart.operators.quality import REASONS, accepted, classify, quarantined
from tallymart.plans import pipeline
from tallymart.plans.pipeline import RunOptions, process
from tallymart.session import written
from tallymart.sources import writers
from tallymart.sources.messy import messy_bronze
from tallymart.sources.paths import LakePaths

KEYS = ("order_id", "line_number")
LATEST = ("sales_clean", "order_date")


def bronze(spark, sf_dir):
    return messy_bronze(spark, sf_dir).withColumn("corrupt_record", F.lit(None).cast("string"))


@pytest.fixture
def lake(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


def same_rows(left, right):
    ordered = right.select(*[F.col(f"`{c}`") for c in left.columns])
    return left.exceptAll(ordered).count() == 0 and left.count() == right.count()


def test_measures_without_a_rule_are_not_staged_and_published_whole(spark, sf_dir, lake, monkeypatch):
    staged = []
    kept = pipeline._stage

    def noted(classified, folder):
        staged.extend(classified.columns)
        return kept(classified, folder)

    monkeypatch.setattr(pipeline, "_stage", noted)
    process(bronze(spark, sf_dir), lake, RunOptions(), "one")
    assert "sales_clean" in staged and not {"profit_clean", "discount_clean", "quantity_clean"} & set(staged)
    whole = classify(clean_orders(bronze(spark, sf_dir)))
    silver = silver_columns(accepted(whole))
    published = spark.read.schema(silver.schema).parquet(lake.silver)
    assert set(published.columns) == set(silver.columns) and same_rows(silver, published)
    rejects = spark.read.parquet(lake.quarantine).drop("run_id")
    assert rejects.columns == whole.columns and same_rows(quarantined(whole), rejects)
    assert rejects.where(F.col("profit_clean").isNotNull() & (F.size(REASONS) > 0)).count() > 0


def test_a_measure_that_ranks_rows_is_staged(spark, sf_dir, lake):
    options = RunOptions(business_keys=KEYS, latest_first=("profit_clean",))
    process(bronze(spark, sf_dir), lake, options, "one", "one")
    best = silver_columns(accepted(classify(clean_orders(bronze(spark, sf_dir))))).groupBy(*KEYS).agg(
        F.max("profit_clean").alias("profit_clean")
    )
    assert same_rows(best, spark.read.parquet(lake.silver_batches).select(*KEYS, "profit_clean"))


def test_ties_are_broken_by_the_same_columns(spark, lake):
    rows = [("1", day, "5", "a") for day in ("12/5/2020", "1/5/2021")]
    df = spark.createDataFrame(rows, "order_id string, order_date string, sales string, category string")
    process(df, lake, RunOptions(business_keys=("order_id",), latest_first=("sales_clean",)), "one", "one")
    assert [tuple(r) for r in spark.read.parquet(lake.silver_batches).select("year", "month").collect()] == [(2021, 1)]


def test_the_period_is_not_shuffled_with_the_ranked_rows(spark, sf_dir):
    silver = written(silver_columns(accepted(classify(clean_orders(bronze(spark, sf_dir))))), "silver")
    options = RunOptions(business_keys=KEYS, latest_first=LATEST)
    kept = pipeline._ranked(silver, options)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.columns == silver.columns
    assert "year(order_date" in plan[: plan.index("Window [")] and "year(order_date" not in plan[plan.index("Window [") :]
    best = dedupe_latest(silver, list(KEYS), pipeline._key_order(silver, options))
    assert same_rows(best, kept)


def test_a_delivery_that_came_before_costs_its_keys(spark, sf_dir, lake, monkeypatch):
    stored = {}
    kept = pipeline.written

    def noted(df, name, folder=None):
        out = kept(df, name, folder)
        stored.setdefault(name, []).append((out.columns, out.count()))
        return out

    monkeypatch.setattr(pipeline, "written", noted)
    options = RunOptions(business_keys=KEYS, latest_first=LATEST)
    first = bronze(spark, sf_dir).where(F.col("` Order ID`").cast("long") % 3 > 0)
    process(first, lake, options, "one", "one")
    process(first, lake, options, "two", "two")
    assert not pipeline.published_rows(spark, lake.silver_batches, "two")
    process(bronze(spark, sf_dir), lake, options, "three", "three")
    silver = silver_columns(accepted(classify(clean_orders(bronze(spark, sf_dir)))))
    rest = silver.where(F.col("order_id").cast("long") % 3 == 0).select(*KEYS).distinct().count()
    assert stored["fresh"] == [(list(KEYS), 0), (list(KEYS), rest)]
    published = spark.read.parquet(lake.silver_batches)
    assert {r["batch_id"]: r["count"] for r in published.groupBy("batch_id").count().collect()}["three"] == rest
    assert same_rows(published.select(*KEYS), silver.select(*KEYS).distinct())


def test_lean_settings_hold_for_a_run_only(spark, sf_dir, lake, monkeypatch):
    seen = []
    before = {k: spark.conf.get(k) for k in writers.LEAN_SETTINGS}
    kept = pipeline._process

    def noted(*args):
        seen.append({k: spark.conf.get(k) for k in writers.LEAN_SETTINGS})
        return kept(*args)

    monkeypatch.setattr(pipeline, "_process", noted)
    process(bronze(spark, sf_dir), lake, RunOptions(), "one")
    assert seen == [writers.LEAN_SETTINGS] and {k: spark.conf.get(k) for k in before} == before
    for file in glob.glob(f"{lake.silver}/**/*.parquet", recursive=True):
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    assert spark.sparkContext.getConf().get("spark.io.compression.codec") == "zstd"


def test_a_delivery_is_packed_in_files_of_bounded_rows(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "RAW_FILE_ROWS", 500)
    raw = str(tmp_path / "raw")
    messy = messy_bronze(spark, sf_dir)
    registry._deliver(messy, raw)
    again = registry._delivered(spark, raw)
    assert again.columns == messy.columns and same_rows(messy, again)
    registry._deliver(again, raw)
    assert same_rows(messy.unionAll(messy), registry._delivered(spark, raw))
    files = glob.glob(f"{raw}/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)
    counts = spark.read.option("header", "true").csv(raw).groupBy(F.input_file_name()).count().collect()
    assert len(counts) == len(files) and max(r["count"] for r in counts) <= 500
