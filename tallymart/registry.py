"""Every operator as a named query over the star-schema tables.

Each query runs over its whole tables.  ``shown`` fixes the result types so
that they mean the same in any SQL engine: dates as ISO text, exact sums as
double, whole numbers as bigint, derived doubles rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.contract import MAX_BAD_FRACTION, gold_schema
from tallymart.functions import measures, naming, values
from tallymart.operators import aggregates as agg
from tallymart.operators import cleaning, customers, dedupe, profile, quality
from tallymart.operators import timeseries as ts
from tallymart.operators.quality import QualityGateError
from tallymart.plans import dashboard, marts
from tallymart.plans.pipeline import RunOptions, run_batch
from tallymart.session import scratch_path, settings, written
from tallymart.sources import readers, writers
from tallymart.sources.messy import messy_bronze
from tallymart.sources.paths import LakePaths
from tallymart.sources.star import good_fact, order_fact, retail_fact, table
from tallymart.streaming import events as ev
from tallymart.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

MONEY_DIGITS, RATIO_DIGITS = 2, 6


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def shown(df: DataFrame, *money: str, exact: tuple[str, ...] = ()) -> DataFrame:
    """Result columns in engine-neutral types.

    ``money`` names derived amounts, ``exact`` doubles that need no rounding
    because they are one division of exact values.
    """
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType) and f.name not in exact:
            c = F.round(c, MONEY_DIGITS if f.name in money else RATIO_DIGITS)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(messy_bronze(spark, sf_dir))


def _stored_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For filters on cleaned values: from stored text, as a lake has it, so that the
    fixture's expressions don't become part of the filter and of the join below it."""
    return cleaning.clean_orders(written(messy_bronze(spark, sf_dir), "bronze"))


def _total_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.to_series(agg.monthly_revenue(good_fact(spark, sf_dir)))


def _series_by(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    return agg.to_series(agg.monthly_revenue(good_fact(spark, sf_dir, *dims), *dims), *dims)


def _stored_series_by(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    """For marts that read their series more than once: the fact is read once."""
    return written(_series_by(spark, sf_dir, *dims), "series")


def _total_of(by_dim: DataFrame) -> DataFrame:
    return by_dim.groupBy("date", "year", "month").agg(F.sum("revenue").alias("revenue"))


# -- names and values ---------------------------------------------------------


def _renamed(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    named = naming.normalize_columns(messy_bronze(spark, sf_dir), mode)
    order, line, quantity, country = (named.columns[i] for i in (0, 1, 7, 9))
    return shown(named.select(*[F.col(f"`{c}`") for c in (order, line, quantity, country)]))


def _filled_counts(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Values of every column under its normalised name."""
    named = naming.normalize_columns(messy_bronze(spark, sf_dir), mode)
    return shown(named.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in named.columns]))


@query
def normalize_all_columns(spark, sf_dir):
    return _filled_counts(spark, sf_dir, "snake")


@query
def normalize_all_columns_strict(spark, sf_dir):
    return _filled_counts(spark, sf_dir, "strict")


@query
def normalize_all_columns_lower(spark, sf_dir):
    return _filled_counts(spark, sf_dir, "lower")


@query
def normalize_columns(spark, sf_dir):
    return _renamed(spark, sf_dir, "snake")


@query
def normalize_columns_strict(spark, sf_dir):
    return _renamed(spark, sf_dir, "strict")


@query
def normalize_columns_lower(spark, sf_dir):
    return _renamed(spark, sf_dir, "lower")


@query
def canonical_columns(spark, sf_dir):
    variants = {"Order Date": "OrderDate", "Sales": "AMOUNT", "[Quantity]": "Qty"}
    cleaned = cleaning.clean_orders(messy_bronze(spark, sf_dir).withColumnsRenamed(variants))
    return shown(cleaned.select("order_id", "order_date", "sales_clean", "quantity_clean"))


@query
def clean_money(spark, sf_dir):
    raw = naming.normalize_columns(messy_bronze(spark, sf_dir))
    columns = ("sales", "profit", "discount")
    cleaned = cleaning.clean_money(raw, *columns)
    return shown(cleaned.select("order_id", "line_number", *[f"{c}_clean" for c in columns]))


@query
def clean_quantity(spark, sf_dir):
    raw = naming.normalize_columns(messy_bronze(spark, sf_dir))
    cleaned = cleaning.clean_quantity(raw, "quantity")
    return shown(cleaned.select("order_id", "line_number", "quantity_clean"))


@query
def parse_dates(spark, sf_dir):
    raw = naming.normalize_columns(messy_bronze(spark, sf_dir))
    parsed = cleaning.parse_dates(raw, "order_date", "ship_date")
    return shown(parsed.select("order_id", "line_number", "order_date", "ship_date"))


@query
def parse_dates_mixed(spark, sf_dir):
    """Seven spellings of a date by order; bare numbers are not dates."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    spellings = ("yyyy-MM-dd", "M/d/yyyy H:mm", "dd-MM-yyyy", "d-MMM-yyyy", "M/d/yy", "yyyy", "D")
    kind = F.pmod("o_orderkey", F.lit(len(spellings)))
    spelt = F.coalesce(*[F.when(kind == i, F.date_format("d", f)) for i, f in enumerate(spellings)])
    raw = orders.withColumn("spelt", F.when(kind == 6, F.lpad(spelt, 5, "3")).otherwise(spelt))
    parsed = raw.withColumn("parsed", values.parse_date(F.col("spelt"), spellings[1:5]))
    return shown(parsed.select("o_orderkey", "spelt", "parsed"))


@query
def standardize_dims(spark, sf_dir):
    padded = naming.normalize_columns(messy_bronze(spark, sf_dir))
    standard = cleaning.standardize_dimensions(padded, "category", "country_market")
    return shown(standard.select("order_id", "line_number", "category", "country_market"))


# -- quality --------------------------------------------------------------------


@query
def good_rows(spark, sf_dir):
    silver = cleaning.silver_columns(quality.good_rows(_stored_typed(spark, sf_dir)))
    return shown(
        silver.select("order_id", "line_number", "order_date", "category", "sales_clean",
                      "quantity_clean", "year", "month", "src_year")
    )


@query
def quarantine_rows(spark, sf_dir):
    rejects = quality.quarantined(quality.classify(_stored_typed(spark, sf_dir)))
    return shown(rejects.select("order_id", "line_number", "order_date", "sales", "reject_reasons"))


@query
def except_all(spark, sf_dir):
    """Only the compared columns are shuffled; the complement filter needs no shuffle at all."""
    cleaned = _stored_typed(spark, sf_dir).select("order_id", "line_number", "order_date", "sales_clean")
    return shown(quality.except_all(cleaned, quality.good_rows(cleaned)))


@query
def quality_metrics(spark, sf_dir):
    metrics = quality.quality_metrics(_typed(spark, sf_dir), quality.is_good())
    passed = F.col("bad_fraction") <= MAX_BAD_FRACTION
    return shown(metrics.withColumn("gate_passed", passed))


@query
def reject_reason_counts(spark, sf_dir):
    return shown(quality.reason_counts(quality.classify(_stored_typed(spark, sf_dir))))


@query
def profile_columns(spark, sf_dir):
    fact = retail_fact(spark, sf_dir, "category").drop("order_date", "ship_date")
    return shown(profile.profile(fact), "mean", "std", "min", "max")


@query
def profile_quartiles(spark, sf_dir):
    quartiles = profile.exact_quantiles(table(spark, sf_dir, "lineitem"))
    return shown(quartiles, exact=("p25", "p50", "p75"))


@query
def null_rates(spark, sf_dir):
    return shown(profile.null_rates(_typed(spark, sf_dir)))


@query
def schema_drift(spark, sf_dir):
    expected = (
        T.StructType()
        .add("o_orderkey", "long")
        .add("o_custkey", "long")
        .add("o_orderstatus", "string")
        .add("o_totalprice", "decimal(18,4)")
        .add("o_orderdate", "timestamp_ntz")
        .add("o_clerk", "string")
    )
    return shown(profile.quality_report(table(spark, sf_dir, "orders"), expected))


@query
def preview_rows(spark, sf_dir):
    fact = good_fact(spark, sf_dir)
    order = ("order_date", "order_id", "line_number", "sales_clean")
    return shown(profile.preview(fact.select(*order), 5, *order))


# -- sources and sinks ------------------------------------------------------------


def _quoted_products(spark: SparkSession, sf_dir: str, accent: str) -> DataFrame:
    fact = retail_fact(spark, sf_dir, "category", "sub_category")
    product = F.concat("sub_category", F.lit(', 3" '), "category", F.lit(f' "{accent}"'))
    return fact.select(
        F.col("order_id").cast("string").alias("Order ID"),
        product.alias("Product Name"),
        F.col("sales_clean").cast("string").alias("Sales"),
    )


def _csv_roundtrip(spark: SparkSession, sf_dir: str, encoding: str, accent: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    source = _quoted_products(spark, sf_dir, accent)
    source.write.options(**writers.CSV_OPTIONS, encoding=encoding).csv(path)
    back = naming.normalize_columns(readers.read_bronze(spark, path, encoding))
    return shown(back.select("order_id", "product_name", F.col("sales").try_cast("double").alias("sales")))


@query
def bronze_csv_scan(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "UTF-8", "记录数")


@query
def bronze_latin1_scan(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "ISO-8859-1", "café")


@query
def silver_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver")
    writers.write_silver(good_fact(spark, sf_dir, "category"), path)
    columns = ["order_date", "sales_clean", "year", "month"]
    return shown(readers.read_silver(spark, path, columns, start=(1996, 7), end=(1999, 6)))


@query
def silver_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver-csv")
    rows = good_fact(spark, sf_dir).select("order_id", "order_date", "sales_clean")
    writers.write_silver_csv(rows, path)
    return shown(readers.read_csv_folder(spark, path, rows.schema))


@query
def gold_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gold-csv")
    writers.export_csv(agg.monthly_revenue(good_fact(spark, sf_dir)), path, "year", "month")
    return shown(readers.read_csv_folder(spark, path, gold_schema()).orderBy("year", "month"))


@query
def month_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "month-csv")
    writers.export_csv(agg.revenue_by_month_date(good_fact(spark, sf_dir)), path, "month")
    schema = T.StructType().add("month", "date").add("sales", "decimal(38,4)")
    return shown(readers.read_csv_folder(spark, path, schema))


# Rows of a raw file at most, and the share of all rows that a file of a small delivery has.
RAW_FILE_ROWS = 1_000_000
RAW_FILES = 4


def _deliver(rows: DataFrame, raw: str) -> None:
    """Rows as packed order files beside those of earlier deliveries.  A packed file is one task's, so its rows are bounded."""
    options = {**writers.CSV_OPTIONS, "compression": "gzip", "maxRecordsPerFile": str(RAW_FILE_ROWS)}
    with settings(rows.sparkSession, writers.LEAN_SETTINGS):
        rows.write.mode("append").options(**options).csv(raw)


def _delivered(spark: SparkSession, raw: str) -> DataFrame:
    """The text that was delivered so far."""
    return readers.read_bronze(spark, raw).drop(readers.CORRUPT)


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "raw")
    messy_bronze(spark, sf_dir).write.options(**writers.CSV_OPTIONS).csv(path)
    return path


def _raw_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """A folder of at least ``RAW_FILES`` files, as many as the data fills, and their number.

    The tasks of the join write them: a fixed number of files would be as many tasks, whatever the data.
    """
    path = scratch_path(spark, "raw")
    rows = table(spark, sf_dir, "lineitem").count()
    options = {**writers.CSV_OPTIONS, "maxRecordsPerFile": str(min(RAW_FILE_ROWS, -(-rows // RAW_FILES)))}
    messy_bronze(spark, sf_dir).write.options(**options).csv(path)
    listing = spark.read.format("binaryFile").load(path).select("path")  # names only, no content
    return path, listing.count()


def _batch_run(spark: SparkSession, sf_dir: str) -> LakePaths:
    paths = LakePaths(scratch_path(spark, "lake"))
    run_batch(spark, _raw_folder(spark, sf_dir), paths, RunOptions())
    return paths


@query
def batch_pipeline_gold(spark, sf_dir):
    paths = _batch_run(spark, sf_dir)
    return shown(marts.read_gold(spark, paths, "monthly_revenue_by_category", ("category",)))


@query
def batch_pipeline_audit(spark, sf_dir):
    log = marts.audit_log(spark, _batch_run(spark, sf_dir))
    return shown(log.select("job_name", "status", "row_in", "row_good", "row_bad", "bad_fraction"))


@query
def batch_pipeline_quarantine(spark, sf_dir):
    paths = _batch_run(spark, sf_dir)
    rejects = spark.read.parquet(paths.quarantine)
    return shown(rejects.select("order_id", "line_number", "sales", "reject_reasons"))


@query
def sql_over_gold(spark, sf_dir):
    paths = _batch_run(spark, sf_dir)
    marts.register_views(spark, paths)
    return shown(
        spark.sql(
            "SELECT m.year, sum(m.total_sales) AS total_sales, count(*) AS months "
            "FROM gold_monthly_revenue m GROUP BY m.year"
        )
    )


@query
def incremental_ingest(spark, sf_dir):
    """Two micro-batches, each of half the files."""
    paths = LakePaths(scratch_path(spark, "lake"))
    raw, files = _raw_files(spark, sf_dir)
    ingest_available(spark, raw, paths, source_options={"maxFilesPerTrigger": str(max(1, -(-files // 2)))})
    return shown(marts.read_gold_batches(spark, paths, "monthly_revenue_by_category", ("category",)))


@query
def mixed_header_ingest(spark, sf_dir):
    """Two headers for the same columns in one folder, and a file that is no order file."""
    paths, raw = LakePaths(scratch_path(spark, "lake")), scratch_path(spark, "raw")
    messy = messy_bronze(spark, sf_dir)
    odd = F.col("` Order ID`").cast("long") % 2 == 1
    renamed = {"Order Date": "OrderDate", "Sales": "Revenue", "Category": "CATEGORY"}
    messy.where(~odd).write.options(**writers.CSV_OPTIONS).csv(raw)
    messy.where(odd).withColumnsRenamed(renamed).drop("Year").write.mode("append").options(
        **writers.CSV_OPTIONS
    ).csv(raw)
    table(spark, sf_dir, "region").write.mode("append").options(**writers.CSV_OPTIONS).csv(raw)
    ingest_available(spark, raw, paths)
    return shown(marts.read_gold_batches(spark, paths, "monthly_revenue_by_category", ("category",)))


@query
def ingest_redelivered_file(spark, sf_dir):
    """All rows delivered twice; a line of an order counts once, its largest amount."""
    paths, raw = LakePaths(scratch_path(spark, "lake")), scratch_path(spark, "raw")
    keys = ("order_id", "line_number")
    options = RunOptions(business_keys=keys, latest_first=("sales_clean", "order_date"))
    _deliver(messy_bronze(spark, sf_dir), raw)
    ingest_available(spark, raw, paths, options)
    _deliver(_delivered(spark, raw), raw)
    ingest_available(spark, raw, paths, options)
    return shown(marts.read_gold_batches(spark, paths, "monthly_revenue"))


@query
def ingest_corrected_rows(spark, sf_dir):
    """Every seventh line comes again with another amount and month; gold moves by the difference."""
    paths, raw = LakePaths(scratch_path(spark, "lake")), scratch_path(spark, "raw")
    keys = ("order_id", "line_number")
    options = RunOptions(business_keys=keys, latest_first=("sales_clean", "order_date"), corrections=True)
    _deliver(messy_bronze(spark, sf_dir), raw)
    ingest_available(spark, raw, paths, options)
    line = F.col("`Line.Number`")
    again = _delivered(spark, raw).where((F.col("` Order ID`").cast("long") + line.cast("long")) % 7 == 3).withColumns(
        {"Sales": F.concat(F.lit("$"), line, F.lit(".50")), "Order Date": F.concat(F.lit("7/15/"), F.col("Year"))}
    )
    _deliver(again, raw)
    ingest_available(spark, raw, paths, options)
    return shown(marts.read_gold_batches(spark, paths, "monthly_revenue"))


@query
def audit_after_replay(spark, sf_dir):
    paths, raw = LakePaths(scratch_path(spark, "lake")), _raw_folder(spark, sf_dir)
    for _ in range(2):
        run_batch(spark, raw, paths, RunOptions(), run_id="again", batch_id="again")
    log = marts.audit_log(spark, paths)
    return shown(log.select("run_id", "status", "row_in", "row_good", "row_duplicate"))


@query
def batch_pipeline_aborted(spark, sf_dir):
    """Above the gate: an audit row and the quarantine under the run's id, and no silver."""
    paths = LakePaths(scratch_path(spark, "lake"))
    try:
        run_batch(spark, _raw_folder(spark, sf_dir), paths, RunOptions(max_bad_fraction=0.0), run_id="stopped")
    except QualityGateError:
        pass
    log = marts.audit_log(spark, paths).select("run_id", "status", "row_bad")
    rejects = spark.read.parquet(paths.quarantine).groupBy("run_id").agg(F.count("*").alias("quarantined"))
    silver = readers.read_optional(spark, paths.silver) is not None
    return shown(log.join(rejects, "run_id").withColumn("silver", F.lit(silver)))


# -- aggregates ---------------------------------------------------------------------


@query
def monthly_revenue(spark, sf_dir):
    return shown(agg.monthly_revenue(good_fact(spark, sf_dir)).orderBy("year", "month"))


@query
def monthly_revenue_by_category(spark, sf_dir):
    return shown(agg.monthly_revenue(good_fact(spark, sf_dir, "category"), "category"))


@query
def monthly_revenue_by_region(spark, sf_dir):
    return shown(agg.monthly_revenue(good_fact(spark, sf_dir, "region"), "region"))


@query
def monthly_revenue_by_country(spark, sf_dir):
    return shown(agg.monthly_revenue(good_fact(spark, sf_dir, "country"), "country"))


@query
def monthly_revenue_date(spark, sf_dir):
    return shown(agg.revenue_by_month_date(good_fact(spark, sf_dir)))


@query
def revenue_by_country(spark, sf_dir):
    return shown(agg.revenue_by(good_fact(spark, sf_dir, "country"), "country"))


@query
def margin_rows(spark, sf_dir):
    rows = agg.with_margin(good_fact(spark, sf_dir))
    return shown(rows.select("order_id", "line_number", "sales_clean", "profit_clean", "profit_margin"))


@query
def kpi_totals(spark, sf_dir):
    return shown(agg.kpi_totals(good_fact(spark, sf_dir)))


@query
def display_labels(spark, sf_dir):
    totals = good_fact(spark, sf_dir, "country", "sub_category").groupBy("country", "sub_category").agg(
        F.sum("sales_clean").alias("revenue"), F.sum("profit_clean").alias("profit")
    )
    margin = measures.ratio(F.col("profit"), F.col("revenue")) * 100
    return shown(
        totals.select(
            "country",
            "sub_category",
            measures.money_label(F.col("revenue")).alias("revenue"),
            measures.percent_label(margin).alias("margin"),
        )
    )


@query
def top_categories(spark, sf_dir):
    return shown(agg.top_by(good_fact(spark, sf_dir, "category"), "category", 5))


@query
def top_categories_latest(spark, sf_dir):
    return shown(agg.latest_top(_series_by(spark, sf_dir, "country"), "country", 10))


@query
def latest_totals(spark, sf_dir):
    return shown(agg.latest_totals(_stored_series_by(spark, sf_dir, "category", "region"), "category"))


@query
def top3_latest(spark, sf_dir):
    series = _series_by(spark, sf_dir, "category", "region")
    return shown(agg.latest_top(series, "category", 3, regroup=True))


@query
def sales_by_region(spark, sf_dir):
    return shown(agg.revenue_by(good_fact(spark, sf_dir, "region"), "region"))


@query
def category_share(spark, sf_dir):
    by_category = agg.revenue_by(good_fact(spark, sf_dir, "category"), "category")
    return shown(agg.revenue_share(written(by_category, "by-category")))


@query
def top_customers(spark, sf_dir):
    return shown(agg.top_by(order_fact(spark, sf_dir), "customer_id", 10))


@query
def pareto_latest(spark, sf_dir):
    return shown(agg.pareto(_series_by(spark, sf_dir, "country"), "country"))


@query
def category_pivot(spark, sf_dir):
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    return shown(agg.pivot_months(_series_by(spark, sf_dir, "category"), "category", kinds))


@query
def category_pivot_all(spark, sf_dir):
    """Over the values that occur; the last column checks that nothing is left out."""
    series = _stored_series_by(spark, sf_dir, "category")
    wide = agg.pivot_occurring(series, "category")
    parts = [F.col(f"`{c}`") for c in wide.columns if c != "date"]
    return shown(wide.withColumn("total", reduce(add, parts)))


@query
def category_pivot_top8(spark, sf_dir):
    return shown(agg.pivot_top(_stored_series_by(spark, sf_dir, "country"), "country"))


@query
def category_series_top8(spark, sf_dir):
    return shown(agg.top_series(_stored_series_by(spark, sf_dir, "country"), "country"))


# -- time series -----------------------------------------------------------------------


@query
def gap_filled_months(spark, sf_dir):
    """Every category x brand x country series: sparse, so most have gaps."""
    keys = ("category", "sub_category", "country")
    return shown(ts.fill_months(_series_by(spark, sf_dir, *keys), *keys))


@query
def calendar_join(spark, sf_dir):
    """Every brand x country series on the calendar of the whole fact."""
    keys = ("sub_category", "country")
    series = _stored_series_by(spark, sf_dir, *keys)
    calendar = written(ts.month_calendar(series), "calendar")
    return shown(ts.on_calendar(series, calendar, *keys))


@query
def gap_filled_by_category(spark, sf_dir):
    keys = ("sub_category", "country")
    return shown(ts.fill_months(_series_by(spark, sf_dir, *keys), *keys))


@query
def mom_yoy_ytd(spark, sf_dir):
    return shown(ts.with_changes(ts.fill_months(_total_series(spark, sf_dir))))


@query
def mom_yoy_ytd_by_country(spark, sf_dir):
    series = ts.fill_months(_series_by(spark, sf_dir, "country"), "country")
    return shown(ts.with_changes(series, "country"))


BAND = ("ma", "std", "band_low", "band_high")


@query
def rolling_band(spark, sf_dir):
    return shown(ts.rolling_band(ts.fill_months(_total_series(spark, sf_dir))), *BAND)


@query
def rolling_band_by_category(spark, sf_dir):
    series = _series_by(spark, sf_dir, "category")
    return shown(ts.rolling_band(ts.fill_months(series, "category"), "category"), *BAND)


@query
def anomaly_flags(spark, sf_dir):
    series = ts.fill_months(_series_by(spark, sf_dir, "category"), "category")
    banded = ts.rolling_band(series, "category", exclude_current=True)
    return shown(banded.select("date", "category", "revenue", "z", "anomaly"))


@query
def anomaly_list(spark, sf_dir):
    series = ts.fill_months(_series_by(spark, sf_dir, "category"), "category")
    listed = ts.anomalies(ts.rolling_band(series, "category"))
    return shown(listed.select("date", "category", "revenue", "ma", "z"), "ma")


@query
def overlay_12v12(spark, sf_dir):
    return shown(ts.overlay(ts.fill_months(_total_series(spark, sf_dir))))


@query
def last_rows(spark, sf_dir):
    series = _series_by(spark, sf_dir, "country")
    return shown(ts.last_months(series, 6, "country"))


@query
def seasonal_naive(spark, sf_dir):
    series = ts.fill_months(_series_by(spark, sf_dir, "category"), "category")
    return shown(ts.seasonal_naive(series, "category"))


@query
def trend_by_category(spark, sf_dir):
    series = ts.fill_months(_series_by(spark, sf_dir, "category"), "category")
    return shown(ts.linear_trend(series, "category"), "slope", "intercept", "forecast")


# -- dashboard ----------------------------------------------------------------------------


@query
def kpi_card(spark, sf_dir):
    return shown(dashboard.kpi_card(_total_series(spark, sf_dir)))


@query
def insights(spark, sf_dir):
    by_category = _stored_series_by(spark, sf_dir, "category")
    return shown(dashboard.insights(_total_of(by_category), by_category))


@query
def dashboard_series(spark, sf_dir):
    base = _stored_series_by(spark, sf_dir, "category", "country")
    period = ("date", "year", "month")
    by_category = base.groupBy(*period, "category").agg(F.sum("revenue").alias("revenue"))
    by_country = base.groupBy("country").agg(F.sum("revenue").alias("revenue"))
    points = dashboard.dashboard_series(_total_of(base), by_category, by_place=by_country)
    return shown(points, "y")


# -- duplicates, customers, events ---------------------------------------------------------


@query
def dedupe_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.desc("l_partkey"), F.desc("l_suppkey")]
    kept = dedupe.dedupe_latest(lines, keys, order)
    return shown(kept.select(*keys, "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"))


@query
def dedupe_exact(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return shown(dedupe.dedupe_exact(pairs))


@query
def dedupe_exact_rows(spark, sf_dir):
    """Whole rows; amounts as exact decimals."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    exact = {f.name: F.col(f.name).cast("decimal(18,4)") for f in lines.schema if isinstance(f.dataType, T.DoubleType)}
    return shown(dedupe.dedupe_exact(lines.withColumns(exact)))


@query
def customer_ltv(spark, sf_dir):
    return shown(customers.lifetime_value(order_fact(spark, sf_dir), order_grain=True), exact=("avg_order_value",))


@query
def customer_churn(spark, sf_dir):
    last = written(customers.last_orders(order_fact(spark, sf_dir)), "last-orders")
    return shown(customers.churn(last))


@query
def customer_retention(spark, sf_dir):
    return shown(customers.retention(order_fact(spark, sf_dir)))


def _drained(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    return ev.drain(stream, scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint"))


@query
def daily_revenue_stream(spark, sf_dir):
    events = ev.event_stream(spark, f"{sf_dir}/events*.parquet")
    return shown(_drained(spark, ev.daily_revenue(events, "event_type"), "daily"))


@query
def daily_revenue_live(spark, sf_dir):
    sink = scratch_path(spark, "live")
    daily = ev.daily_revenue(ev.event_stream(spark, f"{sf_dir}/events*.parquet"), "event_type")
    ev.publish_updates(daily, sink, scratch_path(spark, "live-checkpoint"))
    return shown(ev.current_rows(spark, sink, "day", "event_type"))


@query
def daily_revenue_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return shown(ev.daily_revenue(events, "event_type"))


@query
def distinct_event_stream(spark, sf_dir):
    path = f"{sf_dir}/events*.parquet"
    twice = ev.event_stream(spark, path).unionByName(ev.event_stream(spark, path))
    kept = ev.distinct_events(twice, "event_id", salts=8)
    return shown(_drained(spark, kept.select("event_id", "user_id", "event_type"), "distinct"))
