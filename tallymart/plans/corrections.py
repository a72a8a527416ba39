"""Latest delivery wins: a bucketed key table over batches, and signed deltas to gold.

Every published batch has a number.  Its rows' keys, with what gold made of
them, are a segment of the key table: ``keys/level=0/segment=<number>/bucket=``.
``FAN`` segments of a level are merged into one of the next, the latest row of a
key kept, so the state before a batch is at most ``FAN - 1`` segments of each
level, and of those only the buckets that the batch's own keys fall into.

A batch publishes the rows that are new or differ from the current row of their
key; all rows of the first one are new, so they are published before their state
is made from them.  Its gold holds their sums less those of the rows they replace, whatever
month or category these were in; the replaced rows are listed in ``retracted``.
No earlier silver or gold is read.

A batch counts from the moment its line is in the log, the last thing written.
One that failed has no number and is not seen by readers; one that is done again
keeps its number and sees the state before it, so it replaces itself.  It has to
bring the same rows again.  Batches of one lake are published one at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.contract import MONEY
from tallymart.session import path_exists, written
from tallymart.sources import writers
from tallymart.sources.paths import LakePaths
from tallymart.sources.readers import read_optional

#: Segments of a level that are merged into one of the next.
FAN = 16
LOG_SCHEMA = "number long, buckets int, batch_id string"
TOTAL = T.DecimalType(38, 4)
#: Of a row's SHA-256: every copy of the key table carries it, and it doesn't compress.
DIGEST_BYTES = 16


@dataclass(frozen=True)
class Turn:
    """A batch's number, from 1, and the lake's number of key buckets."""

    batch_id: str
    number: int
    buckets: int


def read_log(spark: SparkSession, paths: LakePaths) -> DataFrame | None:
    """(number, buckets, batch_id) of all published batches, or None in a lake without a key table."""
    return read_optional(spark, paths.key_log, T._parse_datatype_string(LOG_SCHEMA))


def take_turn(spark: SparkSession, paths: LakePaths, batch_id: str, buckets: int) -> Turn:
    """The batch's old number if it was published, else the next one.  The first batch fixes ``buckets``."""
    log = read_log(spark, paths)
    if log is None:
        left = read_optional(spark, paths.silver_batches, T.StructType().add("batch_id", "string"))
        if left is not None and left.where(F.col("batch_id") != batch_id).limit(1).count():  # own rows: it failed before
            raise ValueError(f"{paths.silver_batches} has batches that are not in a key table")
        return Turn(batch_id, 1, buckets)
    own = F.max(F.when(F.col("batch_id") == batch_id, F.col("number")))
    last, mine, fixed = log.agg(F.max("number"), own, F.max("buckets")).first()
    return Turn(batch_id, mine or last + 1, fixed)


def publish_turn(spark: SparkSession, paths: LakePaths, turn: Turn) -> None:
    line = spark.createDataFrame([(turn.number, turn.buckets, turn.batch_id)], LOG_SCHEMA)
    writers.write_batch(line.coalesce(1), paths.key_log)


def cover(number: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(level, segment) of the segments that hold batches 1 to ``number``, each batch once.

    Segment ``i`` of a level holds batches ``i * fan**level + 1`` to ``(i + 1) * fan**level``.
    """
    parts, done, level = [], 0, 0
    while fan ** (level + 1) <= number:
        level += 1
    for depth in range(level, -1, -1):
        size = fan**depth
        while done + size <= number:
            parts.append((depth, done // size))
            done += size
    return parts


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _state_schema(silver: T.StructType, keys: list[str], dims: list[str]) -> T.StructType:
    schema = T.StructType([T.StructField(k, silver[k].dataType) for k in keys])
    for name in ("year", "month"):
        schema = schema.add(f"_{name}", T.IntegerType())
    for place, _ in enumerate(dims):
        schema = schema.add(f"_dim_{place}", T.StringType())
    return (
        schema.add("_has", T.ArrayType(T.StringType())).add("_amount", MONEY).add("_digest", T.BinaryType())
        .add("_owner", T.StringType()).add("_number", T.LongType()).add("bucket", T.IntegerType())
    )


def _as_state(silver: DataFrame, keys: list[str], dims: list[str], turn: Turn) -> DataFrame:
    """Rows of silver with the columns of the key table beside their own."""
    present = set(dims) & set(silver.columns)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(silver.columns)]))
    return silver.withColumns(
        {
            "_year": F.col("year").cast("int"),
            "_month": F.col("month").cast("int"),
            **{f"_dim_{i}": (F.col(d) if d in present else F.lit(None)).cast("string") for i, d in enumerate(dims)},
            "_amount": F.col("sales_clean").cast(MONEY),
            "_digest": F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST_BYTES),
            **_own_values(silver.columns, dims, turn),
            "bucket": bucket_of(keys, turn.buckets),
        }
    )


def _own_values(columns: list[str], dims: list[str], turn: Turn) -> dict[str, Column]:
    """Columns of the key table with one value in all rows of a batch."""
    return {
        "_has": F.array(*[F.lit(d) for d in dims if d in columns]).cast("array<string>"),
        "_owner": F.lit(turn.batch_id),
        "_number": F.lit(turn.number).cast("long"),
    }


def _segment(paths: LakePaths, level: int, place: int) -> str:
    return f"{paths.keys}/level={level}/segment={place:09d}"


def _write_segment(rows: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] = writers.as_is) -> None:
    finish(writers.balanced(rows, "bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _write_own_segment(rows: DataFrame, paths: LakePaths, schema: T.StructType, dims: list[str], turn: Turn) -> None:
    """The batch's own segment; what is one value in all its rows is not shuffled."""
    same = _own_values(rows.columns, dims, turn)
    moved = rows.select(*[n for n in schema.names if n not in same])
    path = _segment(paths, 0, turn.number - 1)
    _write_segment(moved, path, lambda df: df.withColumns(same).select(*schema.names))


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = F.struct(*[F.col(c) for c in rows.columns if c not in keys])
    newest = rows.groupBy(*keys).agg(F.max_by(rest, "_number").alias("_row"))
    return newest.select(*keys, "_row.*")


def _merged(spark: SparkSession, paths: LakePaths, schema: T.StructType, keys: list[str], level: int, place: int) -> str:
    """The path of a segment; one above level 0 is made from those below it where it is missing."""
    path = _segment(paths, level, place)
    if level and not path_exists(spark, f"{path}/_SUCCESS"):
        below = [_merged(spark, paths, schema, keys, level - 1, place * FAN + i) for i in range(FAN)]
        _write_segment(_latest(_read_segments(spark, below, schema), keys), path)
    return path


def _read_segments(spark: SparkSession, segments: list[str], schema: T.StructType) -> DataFrame:
    """Segments as one table.  Each is a folder of its own; at most ``FAN - 1`` of a level are read at once."""
    parts = [spark.read.schema(schema).option("basePath", s).parquet(s) for s in segments]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _old_names(schema: T.StructType, keys: list[str]) -> list[str]:
    return [n for n in schema.names if n not in keys and n != "bucket"]


def first_rows(
    silver: DataFrame, paths: LakePaths, keys: list[str], dims: list[str], turn: Turn, folder: str
) -> DataFrame:
    """What gold makes of a first batch's published rows, and an ``_old`` of NULL, stored in ``folder``.

    The batch's segment is written too; keys and digests are stored there only.
    """
    rows = _as_state(silver, keys, dims, turn)
    schema = _state_schema(rows.schema, keys, dims)
    olds = _old_names(schema, keys)
    _write_own_segment(rows, paths, schema, dims, turn)
    kinds = T.StructType([schema[n] for n in olds])
    changed = rows.select(*[n for n in olds if n != "_digest"], F.lit(None).cast(kinds).alias("_old"))
    return written(changed, "changed", folder)


def changed_rows(
    silver: DataFrame, paths: LakePaths, keys: list[str], dims: list[str], turn: Turn, folder: str
) -> DataFrame:
    """The batch's rows, one a key, that are new or differ from the current row of their key, stored in ``folder``.

    Beside silver's columns they carry those of the key table, and ``_old``: the
    row that each replaces, or NULL.  The batch's segment is written too.
    """
    spark = silver.sparkSession
    columns = silver.columns
    rows = _as_state(silver, keys, dims, turn)
    schema = _state_schema(rows.schema, keys, dims)
    names = [n for n in schema.names if n not in keys]
    olds = _old_names(schema, keys)
    rows = written(rows, "keyed", folder)
    hit = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
    segments = [_merged(spark, paths, schema, keys, *part) for part in cover(turn.number - 1)]
    before = _read_segments(spark, segments, schema).where(F.col("bucket").isin(hit)).drop("bucket")
    current = _latest(before.join(rows.select(*keys), keys, "left_semi"), keys)
    old = current.select(*keys, F.struct(*olds).alias("_old"))
    changed = rows.join(old, keys, "left").where(
        F.col("_old").isNull() | (F.col("_old._digest") != F.col("_digest"))
    )
    changed = written(changed.select(*columns, *names, "_old"), "changed", folder)
    _write_own_segment(changed, paths, schema, dims, turn)
    replaced = changed.where("_old IS NOT NULL").select(
        *keys, F.col("_old._owner").alias("owner"), F.lit(turn.batch_id).alias("batch_id")
    )
    writers.write_batch(replaced, paths.retracted)
    return changed


def signed_marts(changed: DataFrame, marts: dict[str, tuple[str, ...]], dims: list[str], folder: str) -> dict[str, DataFrame]:
    """Per mart the sums of the new rows less those of the rows they replace, and the change in rows.

    A row adds to the marts whose dimensions its own delivery had, and is taken
    back from the same ones.
    """
    places = [f"_dim_{i}" for i in range(len(dims))]
    state = ["_year", "_month", *places, "_has"]
    plus = changed.select(*state, F.col("_amount").cast(TOTAL).alias("_amount"), F.lit(1).alias("_n"))
    old = changed.where("_old IS NOT NULL").select("_old.*")
    minus = old.select(*state, (-F.col("_amount")).cast(TOTAL).alias("_amount"), F.lit(-1).alias("_n"))
    base = plus.unionByName(minus).groupBy(*state).agg(F.sum("_amount").alias("_amount"), F.sum("_n").alias("_n"))
    base = written(base, "signed", folder)
    tables = {}
    for name, wanted in marts.items():
        keys = [F.col("_year").alias("year"), F.col("_month").alias("month")]
        keys += [F.col(places[dims.index(d)]).alias(d) for d in wanted]
        own = base
        for d in wanted:
            own = own.where(F.array_contains("_has", d))
        tables[name] = own.groupBy(*keys).agg(
            F.sum("_amount").cast(TOTAL).alias("total_sales"), F.sum("_n").alias("n_rows")
        )
    return tables


def published(partial: DataFrame, paths: LakePaths) -> DataFrame:
    """Rows of a per-batch table whose batch is in the log; all where the lake has none."""
    log = read_log(partial.sparkSession, paths)
    return partial if log is None else partial.join(log.select("batch_id"), "batch_id", "left_semi")


def current_silver(spark: SparkSession, paths: LakePaths, keys: list[str]) -> DataFrame:
    """The current row of every key: rows of all batches but those that a later one replaced.

    For readers of the rows themselves; gold doesn't need it.  Both sides are joined on the key.
    """
    rows = published(spark.read.option("mergeSchema", "true").parquet(paths.silver_batches), paths)
    replaced = read_optional(spark, paths.retracted)
    if replaced is None:
        return rows
    gone = published(replaced, paths).select(*keys, F.col("owner").alias("batch_id"))
    return rows.join(gone, [*keys, "batch_id"], "left_anti")
