"""What a first batch of correctable rows stores and shuffles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallymart.plans import corrections, marts, pipeline
from tallymart.plans.pipeline import RunOptions, process
from tallymart.sources.messy import messy_bronze
from tallymart.sources.paths import LakePaths
from test_ingest_disk import same_rows

KEYS = ("order_id", "line_number")
OPTIONS = RunOptions(business_keys=KEYS, latest_first=("sales_clean", "order_date"), corrections=True)


@pytest.fixture
def lake(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


@pytest.fixture
def bronze(spark, sf_dir):
    return messy_bronze(spark, sf_dir).withColumn("corrupt_record", F.lit(None).cast("string"))


def test_a_first_batch_is_published_before_its_state_is_made(spark, bronze, lake, monkeypatch):
    stored, moved = {}, []
    kept, segment = corrections.written, corrections._write_segment

    def noted(df, name, folder=None):
        stored[name] = (df.columns, pipeline.published_rows(spark, lake.silver_batches, "one"))
        return kept(df, name, folder)

    def moved_columns(rows, path, *finish):
        moved.append(rows.columns)
        return segment(rows, path, *finish)

    monkeypatch.setattr(corrections, "written", noted)
    monkeypatch.setattr(corrections, "_write_segment", moved_columns)
    process(bronze, lake, OPTIONS, "one", "one")
    columns, published = stored["changed"]
    assert published and not {*KEYS, "_digest", "sales", "profit"} & set(columns)
    assert not {"_owner", "_number", "_has"} & set(moved[0])
    state = spark.read.parquet(corrections._segment(lake, 0, 0))
    assert [tuple(r) for r in state.select("_owner", "_number", "_has").distinct().collect()] == [("one", 1, ["category"])]
    assert same_rows(state.select(*KEYS), corrections.current_silver(spark, lake, list(KEYS)).select(*KEYS))


def test_rows_that_come_again_are_unchanged(spark, bronze, lake):
    for batch_id in ("one", "two"):
        process(bronze, lake, OPTIONS, batch_id, batch_id)
    counts = {r["run_id"]: r["row_good"] - r["row_duplicate"] for r in marts.audit_log(spark, lake).collect()}
    assert counts["one"] > 0 and counts["two"] == 0


def test_a_first_batch_that_failed_is_done_again(spark, bronze, lake, monkeypatch):
    with monkeypatch.context() as m, pytest.raises(ZeroDivisionError):
        m.setattr(corrections, "publish_turn", lambda *a: 1 / 0)
        process(bronze, lake, OPTIONS, "one", "one")
    with pytest.raises(ValueError, match="key table"):
        process(bronze, lake, OPTIONS, "two", "two")
    process(bronze, lake, OPTIONS, "one", "one")
    rows = corrections.current_silver(spark, lake, list(KEYS))
    total = marts.read_gold_batches(spark, lake, "monthly_revenue").agg(F.sum("total_sales")).first()[0]
    assert total == rows.agg(F.sum("sales_clean")).first()[0] > 0
