"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import math
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
ADVISORY_BYTES = 128 * MIB


def shuffle_width(shuffle_bytes: int, floor: int = 200) -> int:
    """Initial shuffle partitions, one for each 128 MiB; AQE merges what is too small."""
    return max(floor, math.ceil(shuffle_bytes / ADVISORY_BYTES))


def split_size(input_bytes: int, tasks: int | None = None) -> int:
    """Scan split for an input size: 128 MiB, or more if the caller bounds the task count."""
    return max(ADVISORY_BYTES, math.ceil(input_bytes / tasks) if tasks else 0)


def build_session(
    app_name: str = "tallymart",
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A UTC session that leaves partition counts, skew and join choice to AQE.

    ``input_bytes`` sets the sizes AQE starts from: scan splits and the shuffle
    width it then merges.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A hot key is split even if the next aggregate then needs a shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_BYTES),
        "spark.sql.parquet.filterPushdown": "true",
        # Shuffled rows of text are half as many bytes as with the default, for the same time.
        "spark.io.compression.codec": "zstd",
    }
    if input_bytes is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            shuffle_width(input_bytes)
        )
        settings["spark.sql.files.maxPartitionBytes"] = str(split_size(input_bytes))
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside; the earlier values come back afterwards."""
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a local folder is used, but only on a local master: on a
    cluster a machine-local folder would not be visible to the other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
    return _local_scratch(spark.sparkContext.applicationId)


@functools.cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallymart-{application_id}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder name below the shared folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, or to ``folder``, and read back.

    Use it for a small aggregate that feeds several branches of one mart: the
    scan below it runs once, and a lost executor re-reads a file instead of
    recomputing the branch.
    """
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer, wherever it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
