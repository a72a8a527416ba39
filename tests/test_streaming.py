from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallymart.operators.aggregates import monthly_revenue
from tallymart.plans import marts
from tallymart.plans.pipeline import RunOptions, process, run_batch
from tallymart.sources.paths import LakePaths
from tallymart.sources.readers import read_bronze
from tallymart.streaming import events as ev
from tallymart.streaming.ingest import ingest_available

ONE_FILE = {"maxFilesPerTrigger": "1"}
HEADER = "Order ID,Order Date,Sales,Category\n"
LINES = [f"{i},{1 + i % 12}/3/{2011 + i % 2},{i + 1}.25,{'abc'[i % 3]}\n" for i in range(60)] + ["60,x,1,a\n"]


def put(folder, parts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in parts.items():
        (folder / name).write_text(HEADER + "".join(lines))
    return str(folder)


def gold(spark, paths, reader):
    table = reader(spark, paths, "monthly_revenue_by_category", ("category",))
    return Counter((r["year"], r["month"], r["category"], r["total_sales"]) for r in table.collect())


@pytest.mark.parametrize("cuts", [[], [7], [20, 21, 50]])
def test_any_split_gives_the_batch_result(spark, tmp_path, cuts):
    whole = LakePaths(str(tmp_path / "whole"))
    run_batch(spark, put(tmp_path / "raw-whole", {"all.csv": LINES}), whole)
    edges = [0, *cuts, len(LINES)]
    parts = {f"p{i}.csv": LINES[a:b] for i, (a, b) in enumerate(zip(edges, edges[1:]))}
    lake = LakePaths(str(tmp_path / "lake"))
    options = RunOptions(job_name="retail_ingest", max_bad_fraction=0.2)
    ingest_available(spark, put(tmp_path / "raw", parts), lake, options, source_options=ONE_FILE)
    assert gold(spark, lake, marts.read_gold_batches) == gold(spark, whole, marts.read_gold)
    assert marts.audit_log(spark, lake).count() == len(parts)
    assert spark.read.parquet(lake.silver_batches).count() == 60
    assert spark.read.parquet(lake.quarantine).count() == 1


def test_only_new_files_are_read(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    raw = tmp_path / "raw"
    put(raw, {"a.csv": LINES[:30]})
    ingest_available(spark, str(raw), lake)
    ingest_available(spark, str(raw), lake)
    assert spark.read.parquet(lake.silver_batches).count() == 30
    put(raw, {"b.csv": LINES[30:60]})
    ingest_available(spark, str(raw), lake)
    assert spark.read.parquet(lake.silver_batches).count() == 60
    stored = spark.read.parquet(lake.silver_batches)
    again = monthly_revenue(stored, "category")
    assert gold(spark, lake, marts.read_gold_batches) == Counter(
        (r["year"], r["month"], r["category"], r["total_sales"]) for r in again.collect()
    )


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    bronze = read_bronze(spark, put(tmp_path / "raw", {"a.csv": LINES[:30]}))
    for _ in range(2):
        process(bronze, lake, RunOptions(), "b-0", batch_id="b-0")
    assert spark.read.parquet(lake.silver_batches).count() == 30
    assert sum(gold(spark, lake, marts.read_gold_batches).values()) == len(
        {(i % 12, i % 2, i % 3) for i in range(30)}
    )


def test_gate_per_batch(spark, tmp_path):
    raw = put(tmp_path / "raw", {"a.csv": LINES[:20], "b.csv": ["1,x,1,a\n"]})
    stopped = LakePaths(str(tmp_path / "stopped"))
    with pytest.raises(StreamingQueryException):
        ingest_available(spark, raw, stopped, source_options=ONE_FILE)
    lake = LakePaths(str(tmp_path / "lake"))
    ingest_available(spark, raw, lake, source_options=ONE_FILE, stop_at_gate=False)
    assert spark.read.parquet(lake.silver_batches).count() == 20
    assert {r["status"] for r in marts.audit_log(spark, lake).collect()} == {"SUCCEEDED", "ABORTED"}


def test_files_of_any_header(spark, tmp_path):
    lake, raw = LakePaths(str(tmp_path / "lake")), tmp_path / "raw"
    put(raw, {"a.csv": LINES[:10]})
    (raw / "b.csv").write_text("Amount,OrderDate,Amount,,Category\n5,2/5/2011,7,x,a\n")
    (raw / "c.csv").write_text("foo,bar\n1,2\n")
    (raw / "d.csv").write_text("")
    ingest_available(spark, str(raw), lake)
    stored = spark.read.parquet(lake.silver_batches)
    assert stored.count() == 11
    other = stored.where("amount_2 is not null").first()
    assert (float(other["sales_clean"]), other["amount_2"], other["column_4"]) == (5.0, "7", "x")
    files = {r["path"].rpartition("/")[2]: r["reason"] for r in spark.read.parquet(lake.rejected_files).collect()}
    assert set(files) == {"c.csv"}  # an empty file holds nothing to report
    assert "Missing required" in files["c.csv"]
    put(raw, {"e.csv": LINES[10:20]})
    ingest_available(spark, str(raw), lake)
    assert spark.read.parquet(lake.silver_batches).count() == 21
    assert sorted(r["status"] for r in marts.audit_log(spark, lake).collect()) == ["FILES_REJECTED", "SUCCEEDED", "SUCCEEDED"]


START = datetime(2024, 1, 1, 6)


def event_files(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, "event_id int, ts timestamp, value double").coalesce(1).write.mode("append").parquet(folder)


def test_closed_days_only_and_late_rows_dropped(spark, tmp_path):
    day = timedelta(days=1)
    first = [(1, START, 1.0), (2, START + day, 2.0), (3, START + 5 * day, 3.0)]
    late = [(4, START + timedelta(hours=1), 50.0), (5, START + 9 * day, 4.0)]
    folder = str(tmp_path / "events")
    event_files(spark, folder, [first])
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    ev.drain(ev.daily_revenue(ev.event_stream(spark, folder)), sink, checkpoint)
    event_files(spark, folder, [late])
    out = ev.drain(ev.daily_revenue(ev.event_stream(spark, folder)), sink, checkpoint)
    got = {r["day"].day: float(r["revenue"]) for r in out.collect()}
    assert got == {1: 1.0, 2: 2.0, 6: 3.0}


def test_open_days_are_published_and_updated(spark, tmp_path):
    day = timedelta(days=1)
    folder, sink, checkpoint = (str(tmp_path / n) for n in ("events", "sink", "checkpoint"))
    for rows in ([(1, START, 1.0), (2, START + day, 2.0)], [(3, START + day, 0.5), (4, START + 2 * day, 4.0)]):
        event_files(spark, folder, [rows])
        ev.publish_updates(ev.daily_revenue(ev.event_stream(spark, folder)), sink, checkpoint)
    got = {r["day"].day: (float(r["revenue"]), r["events"]) for r in ev.current_rows(spark, sink, "day").collect()}
    assert got == {1: (1.0, 1), 2: (2.5, 2), 3: (4.0, 1)}


@pytest.mark.parametrize("salts", [1, 4])
def test_distinct_events(spark, tmp_path, salts):
    folder = str(tmp_path / "events")
    rows = [(i % 5, START, 1.0) for i in range(20)]
    event_files(spark, folder, [rows[:10], rows[10:]])
    stream = ev.event_stream(spark, folder, max_files=1)
    kept = ev.distinct_events(stream, "event_id", salts=salts)
    assert ev.drain(kept, str(tmp_path / "sink"), str(tmp_path / "checkpoint")).count() == 5


def test_daily_revenue_on_a_table(spark):
    df = spark.createDataFrame([(START, 1.0), (START, 2.5)], "ts timestamp, value double")
    row = ev.daily_revenue(df).first()
    assert (float(row["revenue"]), row["events"]) == (3.5, 2)
    assert df.agg(F.count("ts")).first()[0] == 2
