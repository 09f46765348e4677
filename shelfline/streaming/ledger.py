"""Windows of a stream that survive late rows and restarts: states per batch, a sink for late rows, a ledger of batches.

Each micro-batch is reduced to one mergeable state per window and key and stored in a folder of its own.  A row whose
window was closed before the batch began goes to a second sink, whole, and counts nowhere else.  The last step of a batch is
its line in the ledger; folders of batches without a line are not read.  A batch that is run again overwrites what it wrote,
and one that has its line does nothing, so after a restart nothing counts twice and nothing is lost.

The result is the merge of the states: all windows, those still open too, without a second read of the input.  A
window is in the states of those batches only that brought rows for it.  No state store is needed, so the number of
shuffle partitions may change between restarts.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions.numbers import MONEY
from shelfline.operators import partials as P

_LEDGER = "newest_us long, watermark_us long, rows_in_time long, rows_late long"
_MINUTE = 60_000_000


class WindowTable(NamedTuple):
    """``closes``: SQL for the instant, in microseconds, at which a row's window closes; ``delay_minutes``: how far the watermark
    is behind the newest row of earlier batches; ``states``: rows and the names of more keys -> states with ``n_rows``;
    ``results``: states of any number of batches -> finished rows."""

    time: str
    closes: str
    delay_minutes: int
    states: Callable[[DataFrame, tuple[str, ...]], DataFrame]
    results: Callable[[DataFrame], DataFrame]


def _slot_us(time: str, minutes: int) -> str:
    """Start of the slot of ``minutes`` that an instant lies in, in microseconds; also before 1970."""
    return f"(unix_micros({time}) - pmod(unix_micros({time}), {minutes * _MINUTE}L))"


# --- one batch ---------------------------------------------------------------------------------

def _line(spark: SparkSession, path: str, batch: int):
    """The batch's line in the ledger, None if it has none."""
    try:
        return spark.read.schema(_LEDGER).parquet(f"{path}/ledger/batch={batch}").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def take(rows: DataFrame, batch: int, table: WindowTable, path: str) -> None:
    """Stores one batch.  Batches are numbered from 0 without gaps, as a stream does."""
    spark = rows.sparkSession
    if _line(spark, path, batch) is not None:
        return
    before = _line(spark, path, batch - 1) if batch else None
    if batch and before is None:
        raise ValueError(f"batch {batch} without a line of batch {batch - 1} in {path}/ledger")
    newest = before["newest_us"] if before else None
    watermark = None if newest is None else newest - table.delay_minutes * _MINUTE
    late = F.col(table.time).isNull()
    if watermark is not None:
        late = late | (F.expr(table.closes) <= F.lit(watermark))
    flagged = rows.withColumn("is_late", late)
    target = f"{path}/states/batch={batch}"
    (table.states(flagged.withColumn("newest_us", F.unix_micros(table.time)), ("is_late",))
     .write.mode("overwrite").parquet(target))
    # The two sums and the newest time come from the stored states, one row per window and key.
    seen = spark.read.parquet(target).agg(
        F.max(F.when(~F.col("is_late"), F.col("newest_us"))).alias("newest"),
        F.coalesce(F.sum(F.when(~F.col("is_late"), F.col("n_rows"))), F.lit(0)).alias("in_time"),
        F.coalesce(F.sum(F.when(F.col("is_late"), F.col("n_rows"))), F.lit(0)).alias("late")).first()
    if seen["late"]:
        flagged.filter("is_late").drop("is_late").write.mode("overwrite").parquet(f"{path}/late/batch={batch}")
    latest = max((v for v in (newest, seen["newest"]) if v is not None), default=None)
    line = {"newest_us": latest, "watermark_us": watermark, "rows_in_time": seen["in_time"], "rows_late": seen["late"]}
    (spark.range(0, 1, 1, 1).select(*[F.lit(v).cast("long").alias(n) for n, v in line.items()])
     .write.mode("overwrite").parquet(f"{path}/ledger/batch={batch}"))


def run(stream: DataFrame, table: WindowTable, path: str) -> None:
    """Takes in what the stream has not yet given to ``path``, batch by batch; a later call goes on from there."""
    query = (stream.writeStream.foreachBatch(lambda rows, batch: take(rows, batch, table, path))
             .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()


# --- reading -----------------------------------------------------------------------------------

def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One line per finished batch: its number, watermark, rows in time and late."""
    return spark.read.schema(f"{_LEDGER}, batch long").parquet(f"{path}/ledger")


def _finished(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Stored rows of batches that have their line."""
    found = spark.read.parquet(f"{path}/{kind}")
    found = found.withColumn("batch", F.col("batch").cast("long"))
    return found.join(ledger(spark, path).select("batch"), "batch", "left_semi")


def results(spark: SparkSession, table: WindowTable, path: str) -> DataFrame:
    return table.results(_finished(spark, path, "states").filter("NOT is_late"))


def late_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The late rows as they came, with the batch that brought them; None if there never was one."""
    try:
        return _finished(spark, path, "late")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# --- tables ------------------------------------------------------------------------------------

def _of_summary(summary: P.Summary, time: str, closes: str, delay_minutes: int, results) -> WindowTable:
    def states(rows: DataFrame, more: tuple[str, ...]) -> DataFrame:
        columns = {"n_rows": F.count(F.lit(1)), "newest_us": F.max("newest_us")}
        for name, measure in summary.measures.items():
            columns |= P.state_columns(name, measure)
        keys = [F.expr(e).alias(k) for k, e in summary.keys.items()]
        return rows.groupBy(*keys, *more).agg(*[c.alias(n) for n, c in columns.items()])

    return WindowTable(time, closes, delay_minutes, states, results)


def tumbling_counts(delay_minutes: int = 10, width: int = 15) -> WindowTable:
    """Events and mean value per window of ``width`` minutes and event type."""
    start = _slot_us("ts", width)
    summary = P.Summary({"window_start": f"timestamp_micros({start})", "event_type": "event_type"},
                        {"value": P.Measure("value", MONEY)},
                        {"events": lambda: F.col("n_rows"), "avg_value": lambda: P.mean("value", MONEY)})
    return _of_summary(summary, "ts", f"{start} + {width * _MINUTE}L", delay_minutes,
                       lambda parts: P.finished(summary, P.merged(summary, parts)))


def hourly_price(delay_minutes: int = 60) -> WindowTable:
    start = _slot_us("snapshot_time", 60)
    summary = P.Summary({"hour": f"timestamp_micros({start})", "product_name": "product_name", "platform": "platform"},
                        {"price": P.Measure("effective_price", MONEY)},
                        {"avg_price": lambda: P.mean("price", MONEY), "record_count": lambda: F.col("n_rows")})
    return _of_summary(summary, "snapshot_time", f"{start} + {60 * _MINUTE}L", delay_minutes,
                       lambda parts: P.finished(summary, P.merged(summary, parts)))


def sliding_availability(delay_minutes: int = 60, hours: int = 24, by_product: bool = False) -> WindowTable:
    """Availability over ``hours``, every hour, per platform; states are hours of product and platform.

    ``by_product``: per product and platform, the windows that end with an hour in which the pair was seen, one row
    each.  The other windows hold the same rows as one of these, or fewer of its hours."""
    start = _slot_us("snapshot_time", 60)
    summary = P.Summary({"hour": f"timestamp_micros({start})", "product_name": "product_name", "platform": "platform"},
                        {"stocked": P.Measure("in_stock")}, {})

    def share(days: DataFrame, *keys: str) -> DataFrame:
        return days.select("window_start", (F.col("window_start") + F.make_dt_interval(hours=F.lit(hours))).alias("window_end"),
                           *keys, F.try_divide("stocked_sum", "stocked_n").alias("availability_24h"),
                           F.col("stocked_n").alias("record_count"))

    def platforms(parts: DataFrame) -> DataFrame:
        seen = P.merged(summary, parts, ["hour", "platform"])
        days = seen.withColumn("window_start", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(hours - 1)), lambda h: F.col("hour") - F.make_dt_interval(hours=h))))
        return share(days.groupBy("window_start", "platform").agg(
            F.sum("stocked_sum").alias("stocked_sum"), F.sum("stocked_n").alias("stocked_n")), "platform")

    def products(parts: DataFrame) -> DataFrame:
        seen = P.merged(summary, parts).withColumn("h", F.unix_micros("hour"))
        back = Window.partitionBy("product_name", "platform").orderBy("h").rangeBetween(-(hours - 1) * 60 * _MINUTE, 0)
        days = seen.select("product_name", "platform", F.sum("stocked_sum").over(back).alias("stocked_sum"),
                           F.sum("stocked_n").over(back).alias("stocked_n"),
                           (F.col("hour") - F.make_dt_interval(hours=F.lit(hours - 1))).alias("window_start"))
        return share(days, "product_name", "platform")

    return _of_summary(summary, "snapshot_time", f"{start} + {60 * _MINUTE}L", delay_minutes, products if by_product else platforms)


def session_windows(gap_minutes: int = 30, delay_minutes: int = 10) -> WindowTable:
    """Sessions of a user, which end ``gap_minutes`` after their last event.  A state is a user's slot of the gap's length,
    whose events always share a session, so a user with a third of all events has few rows to sort.

    A row is late once a session of its own would have ended."""
    gap = gap_minutes * _MINUTE

    def states(rows: DataFrame, more: tuple[str, ...]) -> DataFrame:
        return rows.groupBy("user_id", F.expr(_slot_us("ts", gap_minutes)).alias("slot"), *more).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("newest_us").alias("first_us"), F.max("newest_us").alias("newest_us"))

    def sessions(parts: DataFrame) -> DataFrame:
        slots = parts.groupBy("user_id", "slot").agg(
            F.sum("n_rows").alias("n"), F.min("first_us").alias("first"), F.max("newest_us").alias("last"))
        order = Window.partitionBy("user_id").orderBy("slot")
        starts = F.coalesce((F.col("first") - F.lag("last").over(order) > gap).cast("int"), F.lit(1))
        numbered = slots.withColumn("starts", starts).withColumn("session_no", F.sum("starts").over(order))
        return numbered.groupBy("user_id", "session_no").agg(
            F.timestamp_micros(F.min("first")).alias("session_start"),
            F.timestamp_micros(F.max("last") + F.lit(gap)).alias("session_end"), F.sum("n").alias("events")).drop("session_no")

    return WindowTable("ts", f"unix_micros(ts) + {gap}L", delay_minutes, states, sessions)
