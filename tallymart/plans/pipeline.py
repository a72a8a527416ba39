"""One run: bronze text -> quarantine, gate, silver, gold, audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.contract import MAX_BAD_FRACTION, METRICS_SCHEMA, OrderContract
from tallymart.operators.cleaning import clean_orders, late_measures, silver_columns, with_period
from tallymart.operators.dedupe import dedupe_exact, dedupe_latest
from tallymart.operators.quality import (
    QualityGateError,
    REASONS,
    RunMetrics,
    check_gate,
    classify,
)
from tallymart.plans import corrections
from tallymart.plans.marts import MARTS, available_marts, base_aggregate, mart_tables
from tallymart.session import remove_path, settings, written
from tallymart.sources import writers
from tallymart.sources.paths import LakePaths, new_run_id
from tallymart.sources.readers import CORRUPT, read_bronze, read_optional

STAGE_FLAG = "_accepted"
#: Of the staging write: the parsing projection as one generated method is too large for the JVM's compiler (8,000
#: bytes), beyond the limit Spark takes small ones; both sides of the flag are open at once instead of sorted.
STAGE_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.maxConcurrentOutputFileWriters": "2"}


@dataclass(frozen=True)
class RunOptions:
    """``drop_duplicates`` removes equal rows among the good ones.  With
    ``business_keys`` a key has one row: within a run the first in the order of
    ``latest_first`` (columns, the largest value first), over batches the one
    that was published first, in whatever month; with ``corrections`` the one
    that was published last, and gold changes by the difference (see
    ``plans.corrections``; ``key_buckets`` is the key table's number of buckets, fixed
    by a lake's first batch).  A row without its key cannot
    be told from others: it is a reject (``missing_<column>``) and counts for the gate.
    ``export`` adds one sorted CSV file per mart and one for the run's metrics;
    ``silver_csv`` adds silver as CSV."""

    job_name: str = "retail_batch"
    contract: OrderContract = field(default_factory=OrderContract)
    encoding: str = "UTF-8"
    multiline: bool = False
    names: str = "snake"
    max_bad_fraction: float = MAX_BAD_FRACTION
    drop_duplicates: bool = False
    business_keys: tuple[str, ...] = ()
    latest_first: tuple[str, ...] = ("order_date", "sales_clean")
    corrections: bool = False
    key_buckets: int = 16
    marts: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(MARTS))
    export: bool = False
    silver_csv: bool = False


@dataclass(frozen=True)
class RunResult:
    run_id: str
    status: str
    metrics: RunMetrics
    marts: tuple[str, ...]


def _stage(classified: DataFrame, folder: str) -> DataFrame:
    """The classified rows as Parquet in the shared folder.

    The raw text is parsed once, in a write without a shuffle; counts, rejects
    and silver all come from this table.  A lost executor costs a re-read of
    some files, and the counts cannot disagree with what is published.
    """
    path = f"{folder}/stage"
    flagged = classified.withColumn(STAGE_FLAG, F.size(REASONS) == 0)
    with settings(classified.sparkSession, STAGE_SETTINGS):
        flagged.write.partitionBy(STAGE_FLAG).parquet(path)
    schema = T.StructType([f for f in flagged.schema if f.name != STAGE_FLAG])
    schema = schema.add(STAGE_FLAG, T.BooleanType())
    return classified.sparkSession.read.schema(schema).parquet(path)


def _stage_metrics(staged: DataFrame) -> RunMetrics:
    """Counts by the partition flag alone: file footers, no column data."""
    counts = {r[STAGE_FLAG]: r["count"] for r in staged.groupBy(STAGE_FLAG).count().collect()}
    return RunMetrics(sum(counts.values()), counts.get(True, 0))


def _completed(late: dict[str, Column], order: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Adds the late measures, in their places; they are neither staged nor shuffled beside their text."""

    def finish(df: DataFrame) -> DataFrame:
        whole = df.withColumns(late)
        placed = [c for c in order if c in whole.columns]
        return whole.select(*[F.col(f"`{c}`") for c in [*placed, *[c for c in whole.columns if c not in order]]])

    return finish


def process(
    bronze: DataFrame,
    paths: LakePaths,
    options: RunOptions,
    run_id: str,
    batch_id: str | None = None,
) -> RunResult:
    """Clean, split, gate and publish one set of raw rows.

    Without ``batch_id`` silver and gold are replaced.  With it they are added
    to the per-batch tables, and doing the same batch again changes nothing.
    Rejects are kept even when the gate stops the run, and so is an audit row.
    """
    with settings(bronze.sparkSession, writers.LEAN_SETTINGS):
        return _process(bronze, paths, options, run_id, batch_id)


def _process(
    bronze: DataFrame, paths: LakePaths, options: RunOptions, run_id: str, batch_id: str | None
) -> RunResult:
    spark = bronze.sparkSession
    started = datetime.now(timezone.utc)
    corrects = options.corrections and batch_id is not None
    if corrects and not options.business_keys:
        raise ValueError("corrections need business keys")
    if batch_id is not None and not corrects and corrections.read_log(spark, paths) is not None:
        raise ValueError(f"{paths.root} has a key table: add batches with corrections")

    def audit(status: str, metrics: RunMetrics, duplicates: int | None = None) -> None:
        writers.write_audit(
            spark,
            paths.audit,
            {
                "run_id": run_id,
                "row_in": metrics.row_in,
                "row_good": metrics.row_good,
                "row_bad": metrics.row_bad,
                "bad_fraction": metrics.bad_fraction,
                "job_name": options.job_name,
                "status": status,
                "started_at": started,
                "finished_at": datetime.now(timezone.utc),
                "row_duplicate": duplicates,
            },
        )

    cleaned = clean_orders(bronze, options.contract, options.names)
    classified = classify(cleaned, date_range=options.contract.date_range, keys=options.business_keys)
    needed = {"sales_clean", *options.latest_first, *options.business_keys}
    late = late_measures(options.contract, classified.columns, needed)
    folder = paths.staging(f"run-{run_id}")
    metrics = RunMetrics(0, 0)
    try:
        staged = _stage(classified.drop(*late), folder)
        metrics = _stage_metrics(staged)
        if metrics.row_bad:
            rejects = staged.where(~F.col(STAGE_FLAG)).drop(STAGE_FLAG)
            writers.write_quarantine(rejects, paths.quarantine, run_id, _completed(late, classified.columns))
        try:
            check_gate(metrics, options.max_bad_fraction)
        except QualityGateError:
            audit("ABORTED", metrics)
            raise
        good = staged.where(STAGE_FLAG).drop(STAGE_FLAG, REASONS, CORRUPT)
        if options.drop_duplicates:
            good = dedupe_exact(good)
        silver = silver_columns(good, options.contract)
        finish = _completed(late, silver_columns(classified.drop(REASONS, CORRUPT), options.contract).columns)
        if corrects:
            marts, published = _publish_corrections(silver, paths, options, folder, batch_id, finish)
        else:
            if options.business_keys:
                silver = _one_per_key(silver, paths, options, batch_id, folder)
            marts, published = _publish(silver, paths, options, folder, batch_id, finish)
        audit("SUCCEEDED", metrics, metrics.row_good - published)
    except QualityGateError:
        raise
    except Exception:
        audit("FAILED", metrics)
        raise
    finally:
        remove_path(spark, folder)
    if options.export:
        _export_metrics(spark, paths, run_id, metrics)
    return RunResult(run_id, "SUCCEEDED", metrics, tuple(marts))


def _key_order(silver: DataFrame, options: RunOptions) -> list:
    """Which row of a key comes first within a batch; no ties but between equal rows."""
    rest = sorted(set(silver.columns) - set(options.business_keys) - set(options.latest_first))
    return [*[F.desc_nulls_last(c) for c in options.latest_first if c in silver.columns], *rest]


def _ranked(silver: DataFrame, options: RunOptions) -> DataFrame:
    """One row a key, the first in the key order.  The period follows from the date and travels only if it is ordered by."""
    keys, ordered = list(options.business_keys), set(options.business_keys) | set(options.latest_first)
    if "order_date" not in ordered or ordered & set(writers.PERIOD):
        return dedupe_latest(silver, keys, _key_order(silver, options))
    slim = silver.drop(*writers.PERIOD)
    kept = with_period(dedupe_latest(slim, keys, _key_order(slim, options)))
    return kept.select(*[F.col(f"`{c}`") for c in silver.columns])


def _publish_corrections(
    silver: DataFrame,
    paths: LakePaths,
    options: RunOptions,
    folder: str,
    batch_id: str,
    finish: Callable[[DataFrame], DataFrame],
) -> tuple[list[str], int]:
    """One batch whose rows replace earlier ones of their keys; the log's line makes it count."""
    spark = silver.sparkSession
    turn = corrections.take_turn(spark, paths, batch_id, options.key_buckets)
    dims = list(dict.fromkeys(d for mart in options.marts.values() for d in mart))
    keys = list(options.business_keys)
    ranked = _ranked(silver, options)
    columns = [F.col(f"`{c}`") for c in finish(silver).columns]
    if turn.number == 1:  # all are new: laid out at once, their state is made from the published rows
        stored = _write_rows(ranked, paths, batch_id, finish)
        changed = corrections.first_rows(stored.select(*columns), paths, keys, dims, turn, folder)
    else:
        changed = corrections.changed_rows(finish(ranked), paths, keys, dims, turn, folder)
        stored = _write_rows(changed.select(*columns), paths, batch_id)
    if options.silver_csv:
        writers.write_silver_csv(stored.select(*columns, "batch_id"), paths.export(f"silver-{batch_id}"))
    for name, table in corrections.signed_marts(changed, options.marts, dims, folder).items():
        writers.write_batch(table.withColumn("batch_id", F.lit(batch_id)), paths.gold_batches(name))
    corrections.publish_turn(spark, paths, turn)
    return list(options.marts), changed.count()


def _one_per_key(
    silver: DataFrame, paths: LakePaths, options: RunOptions, batch_id: str | None, folder: str | None = None
) -> DataFrame:
    """One row a key, and none whose key an earlier batch has.

    Keys of earlier batches go out first, so that their rows are not sorted within their key.
    """
    if batch_id is not None:
        silver = _new_keys(silver, paths, list(options.business_keys), batch_id, folder)
    return _ranked(silver, options)


def _new_keys(
    silver: DataFrame, paths: LakePaths, keys: list[str], batch_id: str, folder: str | None = None
) -> DataFrame:
    """Rows whose key no earlier batch has.  None of their keys is NULL.

    Keys alone are compared; stored in ``folder`` the new ones are counted before any row
    is shuffled, so a delivery that came before costs its keys.
    """
    kinds = {f.name: f for f in silver.schema}
    schema = T.StructType([*[kinds[k] for k in keys], T.StructField("batch_id", T.StringType())])
    before = read_optional(silver.sparkSession, paths.silver_batches, schema)
    if before is None:
        return silver
    # the key columns of all earlier batches: a corrected date must not publish a key again
    others = before.where(F.col("batch_id") != batch_id).select(*keys)
    fresh = silver.select(*keys).distinct().join(others, keys, "left_anti")
    if folder is not None:
        fresh = written(fresh, "fresh", folder)
    return silver.join(fresh, keys, "left_semi")


def _write_rows(
    silver: DataFrame,
    paths: LakePaths,
    batch_id: str,
    finish: Callable[[DataFrame], DataFrame] = writers.as_is,
) -> DataFrame:
    """A batch's rows, published and read back."""
    spark = silver.sparkSession

    def owned(df: DataFrame) -> DataFrame:
        return finish(df).withColumn("batch_id", F.lit(batch_id))

    writers.write_batch(silver, paths.silver_batches, writers.PERIOD, owned)
    schema = owned(silver).schema
    # the batch's own folder alone is listed, however many batches there are
    return (
        spark.read.schema(schema)
        .option("basePath", paths.silver_batches)
        .parquet(f"{paths.silver_batches}/batch_id={batch_id}")
        if published_rows(spark, paths.silver_batches, batch_id)
        else spark.createDataFrame([], schema)
    )


def _publish(
    silver: DataFrame,
    paths: LakePaths,
    options: RunOptions,
    folder: str,
    batch_id: str | None,
    finish: Callable[[DataFrame], DataFrame],
) -> tuple[list[str], int]:
    """The marts written, and the rows of silver by its file footers."""
    spark = silver.sparkSession
    if batch_id is None:
        writers.write_silver(silver, paths.silver, finish=finish)
        stored = spark.read.schema(finish(silver).schema).parquet(paths.silver)
    else:
        stored = _write_rows(silver, paths, batch_id, finish)
    if options.silver_csv:
        writers.write_silver_csv(stored, paths.export(f"silver-{batch_id or 'full'}"))
    marts = available_marts(stored.columns, options.marts)
    base = written(base_aggregate(stored, marts), "base", folder)
    for name, table in mart_tables(base, marts).items():
        if batch_id is None:
            writers.write_gold(table, paths.gold(name))
            if options.export:
                keys = ("year", "month", *marts[name])
                writers.export_csv(table, paths.export(name), *keys, one_file=not marts[name])
        else:
            partial = table.withColumn("batch_id", F.lit(batch_id))
            writers.write_batch(partial, paths.gold_batches(name))
    return list(marts), stored.count()


def published_rows(spark: SparkSession, path: str, batch_id: str) -> bool:
    """Whether a batch left any file: one without new rows leaves no folder."""
    return read_optional(spark, f"{path}/batch_id={batch_id}") is not None


def _export_metrics(
    spark: SparkSession, paths: LakePaths, run_id: str, metrics: RunMetrics
) -> None:
    row = (run_id, metrics.row_in, metrics.row_good, metrics.row_bad, metrics.bad_fraction)
    table = spark.createDataFrame([row], METRICS_SCHEMA)
    writers.export_csv(table, paths.export(f"metrics/run_id={run_id}"))


def run_batch(
    spark: SparkSession,
    raw_path: str,
    paths: LakePaths,
    options: RunOptions = RunOptions(),
    run_id: str | None = None,
    batch_id: str | None = None,
) -> RunResult:
    """Full refresh from CSV files, or one added batch where ``batch_id`` is given."""
    bronze = read_bronze(spark, raw_path, options.encoding, options.multiline)
    return process(bronze, paths, options, run_id or new_run_id(), batch_id)
