from __future__ import annotations

import os
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymart.contract import OrderContract
from tallymart.operators.quality import QualityGateError
from tallymart.plans import marts
from tallymart.plans.pipeline import RunOptions, run_batch
from tallymart.session import shuffle_width, split_size, written
from tallymart.sources.paths import LakePaths

HEADER = "Order ID,Order Date,Sales,Quantity,Category,Region,Year\n"


def line(i, when="2/5/2011", sales="$10.50", category=" Tech "):
    return f'{i},{when},"{sales}",1,{category},West,1999\n'


@pytest.fixture
def lake(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()

    def put(name, lines):
        (folder / name).write_text(HEADER + "".join(lines))
        return str(folder)

    return put


def test_run_publishes_all_layers(spark, lake, raw):
    path = raw("a.csv", [line(i) for i in range(30)] + [line(30, "3/1/2011", "1,000", "Office")] + [line(31, sales="0")])
    options = RunOptions(export=True, silver_csv=True)
    result = run_batch(spark, path, lake, options, run_id="r1")
    assert (result.status, result.metrics.row_in, result.metrics.row_bad) == ("SUCCEEDED", 32, 1)

    silver = spark.read.parquet(lake.silver)
    assert silver.count() == 31
    assert {"sales", "sales_clean", "quantity_clean", "src_year", "year", "month"} <= set(silver.columns)
    assert not {"reject_reasons", "corrupt_record", "_accepted"} & set(silver.columns)

    by_month = {(r["year"], r["month"]): r["total_sales"] for r in marts.read_gold(spark, lake, "monthly_revenue").collect()}
    assert by_month == {(2011, 2): Decimal("315"), (2011, 3): Decimal("1000")}
    categories = marts.read_gold(spark, lake, "monthly_revenue_by_category", ("category",))
    assert {r["category"] for r in categories.collect()} == {"tech", "office"}

    (reject,) = spark.read.parquet(lake.quarantine).collect()
    assert (reject["order_id"], reject["category"], reject["year"], reject["run_id"]) == ("31", " Tech ", "1999", "r1")
    assert reject["reject_reasons"] == ["non_positive_sales"]

    (audit,) = marts.audit_log(spark, lake).collect()
    assert (audit["status"], audit["row_in"], audit["row_good"]) == ("SUCCEEDED", 32, 31)
    assert audit["started_at"] <= audit["finished_at"]

    for name in ("monthly_revenue", "monthly_revenue_by_category", "metrics/run_id=r1"):
        assert len(list(Path(lake.export(name)).glob("*.csv"))) == 1
    assert list(Path(lake.export("silver-full")).glob("*.csv"))
    assert not os.listdir(lake.root + "/_staging")


def test_gate_keeps_rejects_and_an_audit_row_only(spark, lake, raw):
    path = raw("a.csv", [line(i) for i in range(9)] + [line(9, when="x")])
    with pytest.raises(QualityGateError):
        run_batch(spark, path, lake, run_id="bad")
    assert spark.read.parquet(lake.quarantine).count() == 1
    assert not Path(lake.silver).exists() and not Path(lake.gold("monthly_revenue")).exists()
    (audit,) = marts.audit_log(spark, lake).collect()
    assert (audit["status"], audit["bad_fraction"]) == ("ABORTED", 0.1)
    assert not os.listdir(lake.root + "/_staging")


def test_limit_is_a_parameter(spark, lake, raw):
    path = raw("a.csv", [line(i) for i in range(9)] + [line(9, when="x")])
    assert run_batch(spark, path, lake, RunOptions(max_bad_fraction=0.1)).status == "SUCCEEDED"


def test_wrong_width_rows_never_reach_silver(spark, lake, raw):
    path = raw("a.csv", [line(i) for i in range(40)] + ["40,2/5/2011,5\n", "41,2/5/2011,5,1,Tech,West,1999,more\n"])
    result = run_batch(spark, path, lake, RunOptions(max_bad_fraction=0.1))
    assert result.metrics.row_bad == 2
    rejects = spark.read.parquet(lake.quarantine)
    assert rejects.where(F.array_contains("reject_reasons", "corrupt_record")).count() == 2


def test_full_refresh_replaces(spark, lake, raw):
    path = raw("a.csv", [line(i) for i in range(5)])
    run_batch(spark, path, lake, run_id="one")
    run_batch(spark, path, lake, run_id="two")
    assert spark.read.parquet(lake.silver).count() == 5
    assert marts.audit_log(spark, lake).count() == 2


def test_added_batches_sum_up_and_repeat_safely(spark, lake, tmp_path):
    totals = Decimal(0)
    for name, sales in (("a", "1.25"), ("b", "2.50")):
        folder = tmp_path / f"raw-{name}"
        folder.mkdir()
        (folder / "f.csv").write_text(HEADER + line(1, sales=sales) + line(2, "3/9/2012", sales))
        run_batch(spark, str(folder), lake, batch_id=name)
        run_batch(spark, str(folder), lake, batch_id=name)
        totals += 2 * Decimal(sales)
    assert spark.read.parquet(lake.silver_batches).count() == 4
    gold = marts.read_gold_batches(spark, lake, "monthly_revenue")
    assert gold.count() == 2 and gold.agg(F.sum("total_sales")).first()[0] == totals


def test_duplicates_are_dropped_on_request(spark, lake, raw):
    path = raw("a.csv", [line(1), line(1), line(2)])
    run_batch(spark, path, lake, RunOptions(drop_duplicates=True))
    assert spark.read.parquet(lake.silver).count() == 2


def test_business_keys_within_and_across_batches(spark, lake, tmp_path):
    def deliver(name, lines, batch_id):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(HEADER + "".join(lines))
        options = RunOptions(business_keys=("order_id",))
        return run_batch(spark, str(tmp_path / name), lake, options, run_id=batch_id, batch_id=batch_id)

    deliver("a", [line(1, sales="1"), line(1, sales="2"), line(2)], "b1")
    deliver("b", [line(2), line(1, sales="9"), line(3)], "b2")
    deliver("c", [line(3)], "b3")
    rows = {r["order_id"]: r["sales_clean"] for r in spark.read.parquet(lake.silver_batches).collect()}
    assert rows == {"1": Decimal(2), "2": Decimal("10.5"), "3": Decimal("10.5")}
    gold = marts.read_gold_batches(spark, lake, "monthly_revenue")
    assert gold.agg(F.sum("total_sales")).first()[0] == Decimal(23)
    duplicates = {r["run_id"]: (r["row_good"], r["row_duplicate"]) for r in marts.audit_log(spark, lake).collect()}
    assert duplicates == {"b1": (3, 1), "b2": (3, 2), "b3": (1, 1)}


def test_rows_without_their_key_are_rejects(spark, lake, tmp_path):
    (tmp_path / "f.csv").write_text(HEADER + "".join([line(1), line("", sales="5"), line("", sales="7")]))
    options = RunOptions(business_keys=("order_id",), max_bad_fraction=0.7)
    for batch in ("b1", "b2"):  # delivered again, nothing is published
        run_batch(spark, str(tmp_path / "f.csv"), lake, options, run_id=batch, batch_id=batch)
    assert [r["order_id"] for r in spark.read.parquet(lake.silver_batches).collect()] == ["1"]
    rejects = spark.read.parquet(lake.quarantine).collect()
    assert sorted((r["sales"], r["reject_reasons"][0]) for r in rejects) == 2 * [("5", "missing_order_id")] + 2 * [
        ("7", "missing_order_id")
    ]


def test_business_keys_across_months(spark, lake, tmp_path):
    for name, lines in (("a", [line(1, sales="1"), line(2)]), ("b", [line(1, "3/9/2012", "5"), line(3, "3/9/2012")])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(HEADER + "".join(lines))
        run_batch(spark, str(tmp_path / name), lake, RunOptions(business_keys=("order_id",)), batch_id=name)
    rows = [(r["order_id"], r["sales_clean"]) for r in spark.read.parquet(lake.silver_batches).collect()]
    assert sorted(rows) == [("1", Decimal(1)), ("2", Decimal("10.5")), ("3", Decimal("10.5"))]
    assert marts.read_gold_batches(spark, lake, "monthly_revenue").agg(F.sum("total_sales")).first()[0] == Decimal(22)


def test_replay_and_failure_in_the_audit(spark, lake, raw, monkeypatch):
    path = raw("a.csv", [line(i) for i in range(3)])
    for _ in range(2):
        run_batch(spark, path, lake, run_id="same", batch_id="same")
    assert marts.audit_log(spark, lake).count() == 1
    monkeypatch.setattr("tallymart.plans.pipeline.writers.write_gold", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, path, lake, run_id="broken")
    statuses = {r["run_id"]: r["status"] for r in marts.audit_log(spark, lake).collect()}
    assert statuses == {"same": "SUCCEEDED", "broken": "FAILED"}


def test_numbers_and_dates_out_of_range_are_rejects(spark, lake, raw):
    rows = [line(i) for i in range(20)] + [line(20, when="32298"), line(21, when="2/5/1911")]
    contract = OrderContract(date_range=(date(2000, 1, 1), date(2030, 1, 1)))
    run_batch(spark, raw("a.csv", rows), lake, RunOptions(contract=contract, max_bad_fraction=0.2))
    rejects = {r["order_id"]: r["reject_reasons"] for r in spark.read.parquet(lake.quarantine).collect()}
    assert rejects == {"20": ["missing_order_date"], "21": ["order_date_out_of_range"]}


def test_contract_date_formats(spark, lake, raw):
    contract = OrderContract(date_formats=("d.M.yyyy",))
    run_batch(spark, raw("a.csv", [line(1, when="31.12.2012")]), lake, RunOptions(contract=contract))
    assert spark.read.parquet(lake.silver).first()["order_date"] == date(2012, 12, 31)


def test_marts_without_their_dimension_are_skipped(spark, lake, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "f.csv").write_text("OrderDate,Amount\n2/5/2011,3\n")
    result = run_batch(spark, str(folder), lake)
    assert result.marts == ("monthly_revenue",)
    assert marts.read_gold(spark, lake, "monthly_revenue_by_category", ("category",)) is None


def test_more_marts_come_from_one_base(spark, lake, raw):
    wanted = {"by_region": ("region",), "by_both": ("category", "region"), "total": ()}
    result = run_batch(spark, raw("a.csv", [line(i) for i in range(4)]), lake, RunOptions(marts=wanted))
    assert set(result.marts) == set(wanted)
    assert marts.read_gold(spark, lake, "by_both", ("category", "region")).first()["total_sales"] == Decimal("42")


def test_sql_views_and_tables(spark, lake, raw):
    run_batch(spark, raw("a.csv", [line(i) for i in range(4)]), lake)
    assert marts.register_views(spark, lake) == ["gold_monthly_revenue", "gold_monthly_revenue_by_category"]
    assert spark.sql("SELECT sum(total_sales) FROM gold_monthly_revenue").first()[0] == Decimal("42")
    assert marts.save_tables(spark, lake, "retail_test") == [
        "retail_test.monthly_revenue", "retail_test.monthly_revenue_by_category",
    ]
    assert spark.table("retail_test.monthly_revenue").count() == 1


def test_written_reads_back(spark):
    assert written(spark.range(4), "numbers").count() == 4


def test_shuffle_width():
    assert shuffle_width(0) == 200
    assert shuffle_width(100 * 1024**4) == 819_200
    assert shuffle_width(128 * 1024**2 * 1000) == 1000


def test_split_size():
    mib = 1024**2
    assert split_size(0) == 128 * mib
    assert split_size(100 * 1024**4) == 128 * mib
    assert split_size(100 * 1024**4, tasks=200_000) == 100 * 1024**4 // 200_000 + 1
