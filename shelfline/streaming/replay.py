"""Structured Streaming over replayed files.

Batch and stream share the transformations; here are the windowed, stateful ones.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.numbers import MONEY, exact_avg
from shelfline.session import new_folder

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_of(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A table's files as a stream.  The schema is that of the files, read once.

    The path is given as a pattern that matches only itself: a stream source takes a plain path
    for a folder, while a pattern may match a single file too."""
    path = path.rstrip("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def replay(result: DataFrame, label: str) -> DataFrame:
    """Runs an append-mode query until its input is used up; result and checkpoint are written
    to the shared folder, so a lost executor or driver resumes from there."""
    return _run(result, label)[0]


def replay_whole(build: Callable[[DataFrame], DataFrame], stream: DataFrame, rows: DataFrame, end: Column,
                 label: str) -> DataFrame:
    """``replay`` of ``build(stream)``, and the windows that its last watermark has not closed: those of ``build(rows)``, the
    same input read at once, whose ``end`` is later.

    Rows that were too late for a closed hour or session, in a replay of several batches, count in the open windows above it."""
    closed, watermark = _run(build(stream), label)
    left = build(rows)
    return closed.unionByName(left if watermark is None else left.filter(end > F.to_timestamp(F.lit(watermark))))


def _run(result: DataFrame, label: str) -> tuple[DataFrame, str | None]:
    """The stored result, and the watermark of the last batch; none without any input."""
    spark = result.sparkSession
    target = new_folder(spark, f"stream-{label}")
    # State on disk rather than on the heap; sessions are merged before the shuffle.
    values = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
              "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    with _settings(spark, values):
        query = (result.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                 .option("path", f"{target}/rows").option("checkpointLocation", f"{target}/checkpoint").start())
        query.awaitTermination()
    last = query.lastProgress
    watermark = last["eventTime"].get("watermark") if last else None
    return spark.read.schema(result.schema).parquet(f"{target}/rows"), watermark


def tumbling_counts(events: DataFrame, delay: str = "10 minutes", width: str = "15 minutes") -> DataFrame:
    windows = events.withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type")
    return windows.agg(F.count(F.lit(1)).alias("events"),
                       exact_avg("value", MONEY).alias("avg_value")).select(
        F.col("window.start").alias("window_start"), "event_type", "events", "avg_value")


def hourly_price(listings: DataFrame, delay: str = "1 hour") -> DataFrame:
    windows = listings.withWatermark("snapshot_time", delay).groupBy(
        F.window("snapshot_time", "1 hour"), "product_name", "platform")
    return windows.agg(
        exact_avg("effective_price", MONEY).alias("avg_price"), F.count(F.lit(1)).alias("record_count")).select(
        F.col("window.start").alias("hour"), "product_name", "platform", "avg_price", "record_count")


def sliding_availability(listings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Availability over 24 hours, every hour.  Hours are counted first and the sliding window
    runs over the hours, so a row is not copied into 24 windows."""
    hours = listings.withWatermark("snapshot_time", delay).groupBy(
        F.window("snapshot_time", "1 hour").alias("hour"), "platform").agg(
        F.count_if("in_stock").alias("stocked"), F.count("in_stock").alias("n"))
    days = hours.groupBy(F.window("hour", "24 hours", "1 hour").alias("day"), "platform").agg(
        F.sum("stocked").alias("stocked"), F.sum("n").alias("n"))
    return days.select(F.col("day.start").alias("window_start"), F.col("day.end").alias("window_end"), "platform",
                       (F.col("stocked") / F.col("n")).alias("availability_24h"), F.col("n").alias("record_count"))


def deduplicated(events: DataFrame, key: str = "event_id", delay: str = "10 minutes") -> DataFrame:
    """State holds ids only until the watermark has passed them."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def session_windows(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    windows = events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), "user_id")
    return windows.agg(F.count(F.lit(1)).alias("events")).select(
        "user_id", F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"), "events")
