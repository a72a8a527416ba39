"""Event-time aggregates: late rows are dropped, closed days are final."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.dedupe import dedupe_latest


def event_stream(
    spark: SparkSession, path: str, ts: str = "ts", max_files: int | None = None
) -> DataFrame:
    """A streaming Parquet scan of a folder or file pattern.

    The event time is cast to a type that can carry a watermark.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def daily_revenue(
    events: DataFrame,
    *keys: str,
    ts: str = "ts",
    amount: str = "value",
    delay: str = "1 day",
) -> DataFrame:
    """Revenue and event count per day and key; works on batch tables too."""
    day = F.window(ts, "1 day").alias("day")
    exact = F.col(amount).cast("decimal(18,4)")
    return (
        events.withWatermark(ts, delay)
        .groupBy(day, *keys)
        .agg(F.sum(exact).alias("revenue"), F.count(F.lit(1)).alias("events"))
        .select(F.to_date(F.col("day.start")).alias("day"), *keys, "revenue", "events")
    )


def distinct_events(
    events: DataFrame, *keys: str, ts: str = "ts", delay: str = "1 day", salts: int = 1
) -> DataFrame:
    """The first event per key; state is kept only as long as copies may come.

    Copies of one event all meet in one task.  Where such a group can be large,
    ``salts`` first removes copies within that many parts of each group; what
    is left of a group is then at most ``salts`` rows.  It keeps more state, so
    it is off by default.
    """
    marked = events.withWatermark(ts, delay)
    if salts > 1:
        spread = F.floor(F.rand(seed=1) * salts).cast("int")
        parted = marked.withColumn("_salt", spread)
        marked = parted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def drain(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there now into Parquet files and read them."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(sink)


def publish_updates(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Write every changed row of an aggregate, open days included.

    A micro-batch is one ``batch=`` folder, so a replayed one replaces itself.
    """

    def publish(changed: DataFrame, number: int) -> None:
        (
            changed.withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(sink)
        )

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_rows(spark: SparkSession, sink: str, *keys: str) -> DataFrame:
    """The last published row of each key."""
    published = spark.read.parquet(sink)
    return dedupe_latest(published, list(keys), [F.desc("batch")]).drop("batch")
