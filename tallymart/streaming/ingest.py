"""New raw files only: each file is processed once, by the batch run's steps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tallymart.functions.naming import normalize_columns
from tallymart.operators.quality import QualityGateError
from tallymart.operators.schema import MissingColumnsError, canonical
from tallymart.plans.pipeline import RunOptions, process
from tallymart.sources import writers
from tallymart.sources.paths import LakePaths
from tallymart.sources.readers import csv_header, read_bronze

FILE_SCHEMA = "path string, header array<string>, reason string, run_id string"
#: Files of a micro-batch where the caller sets no bound of their own.
FILES_PER_BATCH = "1000"


def file_stream(
    spark: SparkSession, path: str, source_options: dict[str, str] | None = None
) -> DataFrame:
    """A streaming list of the files in a folder; their content is not read.

    ``source_options`` go to the file source: ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bound a micro-batch, ``cleanSource`` moves files
    that are done out of the folder so that listing it stays cheap.
    """
    options = dict(source_options or {})
    if not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & options.keys():
        options["maxFilesPerTrigger"] = FILES_PER_BATCH
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(schema).options(**options)
    return stream.load(path).select("path")


def read_files(
    spark: SparkSession, files: list[str], options: RunOptions
) -> tuple[DataFrame | None, list[tuple[str, list[str], str]]]:
    """Files of any header as one table of contract columns, and (path, header, reason) of the rest.

    Files are read together by header, so a file costs one look at its first
    line.  A column that only some files have is NULL for the others.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        by_header.setdefault(tuple(csv_header(spark, file, options.encoding)), []).append(file)
    tables, rejected = [], []
    for header, group in by_header.items():
        try:
            if not header:
                raise MissingColumnsError("the file has no header")
            bronze = read_bronze(spark, group, options.encoding, options.multiline, list(header))
            tables.append(canonical(normalize_columns(bronze, options.names), options.contract))
        except MissingColumnsError as error:
            rejected += [(file, list(header), str(error)) for file in group]
    if not tables:
        return None, rejected
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged, rejected


def reject_files(
    spark: SparkSession, rejected: list[tuple[str, list[str], str]], paths: LakePaths, options: RunOptions, run_id: str
) -> None:
    """Rejected files below ``run_id=`` of their own table, and an audit row; a replay replaces both."""
    table = spark.createDataFrame([(*r, run_id) for r in rejected], FILE_SCHEMA)
    writers.write_quarantine(table.drop("run_id"), paths.rejected_files, run_id)
    now = datetime.now(timezone.utc)
    zero = {"row_in": 0, "row_good": 0, "row_bad": 0, "bad_fraction": 0.0}
    row = {"job_name": options.job_name, "status": "FILES_REJECTED", "started_at": now, "finished_at": now}
    writers.write_audit(spark, paths.audit, {"run_id": run_id, **zero, **row})


def ingest_available(
    spark: SparkSession,
    raw_path: str,
    paths: LakePaths,
    options: RunOptions = RunOptions(job_name="retail_ingest"),
    source_options: dict[str, str] | None = None,
    stream: str = "orders",
    stop_at_gate: bool = True,
) -> None:
    """Process every file that is not in the checkpoint yet, then stop.

    A micro-batch is one batch of the per-batch tables, under its own id, so a
    batch that is replayed after a failure replaces itself.  Files may have
    different headers; one that lacks a required column is set aside with its
    reason and the stream goes on.  A batch above the gate stops the stream, and
    is tried again at the next start; without ``stop_at_gate`` it is left in
    quarantine and the stream goes on.
    """

    def publish(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream}-{number:09d}"
        files = sorted(r["path"] for r in batch.collect())  # as many as the trigger allows
        bronze, rejected = read_files(spark, files, options)
        if rejected:
            reject_files(spark, rejected, paths, options, f"{batch_id}-files")
        if bronze is None:
            return
        try:
            process(bronze, paths, options, run_id=batch_id, batch_id=batch_id)
        except QualityGateError:
            if stop_at_gate:
                raise

    query = (
        file_stream(spark, raw_path, source_options)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", paths.checkpoint(stream))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
