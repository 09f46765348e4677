"""Usage metrics over an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions.percentiles import exact_percentiles

# Types with a column of their own in the sessions, and a row in the measures even if no event has them.
EVENT_TYPES = ("view", "click", "signup", "purchase", "error")


def monthly_active_users(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_format("ts", "yyyy-MM").alias("month")).agg(
        F.count_distinct("user_id").alias("active_users"))


def sessions(events: DataFrame, gap_minutes: int = 30, types=EVENT_TYPES) -> DataFrame:
    """Sessions of a user: a gap longer than ``gap_minutes`` begins a new one.

    Events of one user in one slot of the gap's length always share a session, so each slot is
    first reduced to its ends and counts.  The window then sorts at most one row per user and
    slot: a user with a third of all events costs no more than any other.

    ``by_type`` has the counts of all types that the session has, whatever they are (null too);
    those of ``types`` are columns besides.
    """
    gap = gap_minutes * 60_000_000
    slots = events.groupBy("user_id", F.floor(F.unix_micros("ts") / gap).alias("slot"), "event_type").agg(
        F.min(F.unix_micros("ts")).alias("first"), F.max(F.unix_micros("ts")).alias("last"), F.count(F.lit(1)).alias("n"))
    slots = slots.groupBy("user_id", "slot").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.collect_list(F.struct("event_type", "n")).alias("in_slot"))
    order = Window.partitionBy("user_id").orderBy("slot")
    starts = F.coalesce((F.col("first") - F.lag("last").over(order) > gap).cast("int"), F.lit(1))
    numbered = slots.withColumn("starts", starts).withColumn("session_no", F.sum("starts").over(order))
    # A session may have very many slots, so they are counted per type before they are put together.
    typed = numbered.select("user_id", "session_no", "first", "last", F.inline("in_slot")).groupBy(
        "user_id", "session_no", "event_type").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    return typed.groupBy("user_id", "session_no").agg(
        F.timestamp_micros(F.min("first")).alias("session_start"),
        F.timestamp_micros(F.max("last")).alias("session_end"),
        F.sum("n").alias("events"),
        ((F.max("last") - F.min("first")) / F.lit(1e6)).alias("duration_sec"),
        *[F.sum(F.when(F.col("event_type") == t, F.col("n")).otherwise(0)).alias(t) for t in types],
        F.collect_list(F.struct("event_type", "n")).alias("by_type"))


def session_summary(per_session: DataFrame) -> DataFrame:
    micros = F.sum(F.rint(F.col("duration_sec") * 1e6).cast("bigint"))
    return per_session.groupBy(F.to_date("session_start").alias("date")).agg(
        F.count(F.lit(1)).alias("sessions"), (micros / F.count(F.lit(1)) / F.lit(1e6)).alias("mean_duration_sec"))


def _by_type(per_session: DataFrame, measure, name: str, types=EVENT_TYPES) -> DataFrame:
    """One row per event type of the sessions, and of ``types``, over the number of all sessions.

    Every session adds a row to the total and an empty one to each of ``types``; they are summed before any shuffle,
    and the window that spreads the total sorts one row per type."""
    def entry(event_type, n, total=0):
        return F.struct(event_type.cast("string").alias("event_type"), n.cast("bigint").alias("n"), F.lit(total).alias("total"))

    found = F.transform("by_type", lambda e: entry(e["event_type"], e["n"]))
    added = F.array(*[entry(F.lit(t), F.lit(0)) for t in types], entry(F.lit(None), F.lit(0), 1))
    summed = per_session.select(F.inline(F.concat(found, added))).groupBy("event_type", "total").agg(
        measure(F.col("n")).alias("v"), F.sum("total").alias("counted"))
    sessions = F.max("counted").over(Window.partitionBy(F.lit(0)))
    return summed.withColumn("sessions", sessions).filter("total = 0").select(
        "event_type", "sessions", (F.col("v") / F.col("sessions")).alias(name))


def session_share(per_session: DataFrame) -> DataFrame:
    """Share of sessions that have at least one event of the type."""
    return _by_type(per_session, lambda c: F.count_if(c > 0), "share")


def events_per_session(per_session: DataFrame) -> DataFrame:
    return _by_type(per_session, F.sum, "events_per_session")


def return_rate(events: DataFrame, days: int = 7) -> DataFrame:
    """Per first-visit day: users, and those seen again on a later day within ``days``."""
    seen = events.select("user_id", F.to_date("ts").alias("day")).distinct()
    first = F.min("day").over(Window.partitionBy("user_id"))
    back = F.datediff("day", "first_day").between(1, days)
    users = seen.withColumn("first_day", first).groupBy("user_id", "first_day").agg(
        F.max(back.cast("int")).alias("returned"))
    return users.groupBy("first_day").agg(
        F.count(F.lit(1)).alias("users"), F.sum("returned").alias("returned"),
        (F.sum("returned") / F.count(F.lit(1))).alias("return_rate"))


def value_percentile(events: DataFrame, fraction: float = 0.95) -> DataFrame:
    return exact_percentiles(events, ["event_type"], "value", {"p_value": fraction})


def arrival_batch(arrival: str, batch_minutes: int = 60):
    """Number of the arrival slot that one stream batch would read."""
    return F.floor(F.unix_micros(arrival) / (batch_minutes * 60_000_000))


def batch_watermarks(events: DataFrame, arrival: str, batch_minutes: int = 60, delay_minutes: int = 30) -> DataFrame:
    """Watermark of each batch: the newest event time of all earlier batches, less the delay.

    The running maximum sorts one row per batch; their number is the time span over the batch
    length, whatever the number of events."""
    newest = events.groupBy(arrival_batch(arrival, batch_minutes).alias("batch")).agg(F.max("ts").alias("newest"))
    before = Window.partitionBy(F.lit(0)).orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    return newest.select("batch", (F.max("newest").over(before)
                                   - F.make_dt_interval(mins=F.lit(delay_minutes))).alias("watermark"))


def late_rows(events: DataFrame, arrival: str, watermarks: DataFrame, batch_minutes: int = 60) -> DataFrame:
    """Audit of late data: rows behind the watermark of the batch they arrive in.

    (Stateful operators compare with the batch before, so they may still take some of these.)"""
    rows = events.withColumn("batch", arrival_batch(arrival, batch_minutes))
    return rows.join(watermarks, "batch").filter("ts < watermark")
