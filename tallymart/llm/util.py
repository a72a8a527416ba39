"""Helpers shared by the text operators: words, bounded batches, files in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.session import scratch_path

#: Text handled at once inside a task, in UTF-8 bytes; one longer text is a slice of its own.
CHUNK_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower_words(text: str | None) -> list[bytes]:
    """UTF-8 words between the six ASCII white-space characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose ``column`` holds about ``limit`` bytes at most.

    Bounds what a task turns into Python objects at once, whatever the batch size is.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            held += n or 0
            if held >= limit:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores put before one until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that all machines share (``spark.checkpoint.dir``)."""
    return scratch_path(spark, name)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if not path.startswith("file:/") else "file://" + _plain(path))


def _plain(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/")


#: A side is broadcast only if it was stored and counted to have no more rows.
BROADCAST_ROWS = 500_000


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: short lineage, and no step runs twice."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, to be broadcast if its counted rows are few; else joined by shuffle."""
    return F.broadcast(table) if table.count() <= limit else table
