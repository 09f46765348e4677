"""Unified rows and their aggregate tables, kept up to date batch by batch.

Rows and states lie in folders (those of the store, then the batch).  A batch adds its new rows and their
states to the folders that it touches, and the aggregate tables are made anew for the days of its rows only, by merging the stored
states of these days: rows of other folders or days, and rows that earlier batches brought to the same day, are not aggregated
again.  Tables lie in folders of the store, then the version.  A day's new rows are written as a version of their own, and a
marker says, once all tables are written, that this version counts for the day.  What no longer counts stays until the next full run.

A row whose key is already stored is the same listing once more.  As in a full run the first of all copies, in the order of their
columns, stays.  Mostly the stored one does, and the new one goes.  Where the new one does, the batch writes all rows of
that folder, and a marker says that the earlier batches of the folder no longer count.

Every step overwrites what the same batch wrote before, so a batch that broke off is run again as it is.  One
batch at a time may run on a store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators import normalise, partials, quality
from shelfline.schema import DEDUP_KEY
from shelfline.sources import zones

_MARK, _AUDIT, _CURRENT = "superseded", "states_audit", "current_days"
_TYPES = {**zones.PARTITION_TYPES, "batch": T.LongType(), "version": T.LongType()}
# Four of the five summaries have these keys, so that rows dealt out by them once serve all.
_COMMON = ("product_name", "category", "platform", "date")


@dataclass(frozen=True)
class Store:
    """Where the tables of one deployment are, and the folders of its dated tables."""

    root: str
    partitions: tuple[str, ...] = zones.PARTITIONS

    def processed(self, name: str) -> str:
        return f"{self.root}/processed/{name}"

    def curated(self, name: str) -> str:
        return f"{self.root}/curated/{name}"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.to_date("snapshot_time"))


def _folders(store) -> tuple[str, ...]:
    return (*store.partitions, "batch")


def _few_folders(store) -> bool:
    """Without days each task may write its share of every folder, so rows need no shuffle to find their folder."""
    return "date" not in store.partitions


def _markers(spark: SparkSession, store, name: str = _MARK) -> DataFrame:
    kinds = {"date": "date", "platform": "string"}
    columns = [*store.partitions, "batch"] if name == _MARK else [*_days(store), "version"]
    kinds |= {"batch": "long", "version": "long"}
    return spark.read.schema(", ".join([f"{c} {kinds.get(c, 'string')}" for c in columns])).parquet(store.processed(name))


def _days(store) -> tuple[str, ...]:
    return tuple(dict.fromkeys((*store.partitions, "date")))


def _same(left: str, right: str, columns) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def read(spark: SparkSession, store, name: str) -> DataFrame:
    """A table's rows that count.  A table written without batches, or without markers, is read as it is."""
    rows = zones.read_zone(spark, store.processed(name), _TYPES)
    if "version" in rows.columns:
        return _current(spark, store, rows)
    return _counting(spark, store, rows) if "batch" in rows.columns else rows


def _current(spark: SparkSession, store, rows: DataFrame) -> DataFrame:
    """Rows of a table of the version that counts for their day: the last that a marker names, else that of the full run."""
    marks = _markers(spark, store, _CURRENT)
    if marks.isEmpty():
        return rows.filter("version = 0").drop("version")
    since = marks.groupBy(*_days(store)).agg(F.max("version").alias("since"))  # one row per day that batches touched
    found = rows.alias("r").join(since.alias("s"), _same("r", "s", _days(store)), "left")
    return found.filter(F.col("r.version") == F.coalesce("s.since", F.lit(0))).select("r.*").drop("version")


def _counting(spark: SparkSession, store, rows: DataFrame, but: int | None = None) -> DataFrame:
    """``rows`` without those of batches that a later one holds too; ``but``: a batch whose markers are not looked at."""
    marks = _markers(spark, store)
    marks = marks if but is None else marks.filter(F.col("batch") != but)
    if marks.isEmpty():
        return rows
    since = marks.groupBy(*store.partitions).agg(F.max("batch").alias("since"))  # one row per folder that was written anew
    on = _same("r", "s", store.partitions) & (F.col("r.batch") < F.col("s.since"))
    return rows.alias("r").join(since.alias("s"), on, "left_anti")


def _write_states(rows: DataFrame, store, rebuild: bool) -> None:
    """``rows`` have ``date``, the partition columns and ``batch``.  They are dealt out once, by the keys that the summaries
    share, and kept while the summaries are made of them."""
    by_batch = {name: s._replace(keys={**s.keys, "date": "date", "batch": "batch"}) for name, s in partials.SUMMARIES.items()}
    needed = dict.fromkeys([*_COMMON, *store.partitions, *[c for s in by_batch.values() for c in s.keys.values()],
                            *[m.column for s in by_batch.values() for m in s.measures.values()]])
    laid = rows.select(*needed).repartition(*_COMMON).persist()
    for name, summary in by_batch.items():
        zones.write_zone(partials.states(summary, laid), store.processed(f"states_{name}"), _folders(store), rebuild,
                         rebalance=not _few_folders(store))
    laid.unpersist()
    summary = quality.audit_states(rows, *dict.fromkeys((*_folders(store), "platform")))
    zones.write_zone(summary, store.processed(_AUDIT), _folders(store), rebuild)


def audit(spark: SparkSession, store) -> DataFrame:
    """The overall audit of the rows that count, from the summaries of the folders."""
    return quality.audit_overall(read(spark, store, _AUDIT))


def newest(spark: SparkSession, store) -> Column:
    """Time of the newest row, from the summaries of the folders; the rows are not read.  A table that was written without
    batches has no summaries, so there it is a maximum over the rows."""
    rows = zones.read_zone(spark, store.processed("unified"), _TYPES)
    if "batch" not in rows.columns:
        return rows.agg(F.max("snapshot_time")).scalar()
    return read(spark, store, _AUDIT).agg(F.max("last_time")).scalar()


def _write_tables(spark: SparkSession, store, touched: list | None = None, days: DataFrame | None = None) -> None:
    """Aggregate tables of the ``days`` in the ``touched`` folders as a new version, or of all rows as version 0.

    A group of a day that one batch alone brought has one state, which is final as it is; other states are merged."""
    folders = (*store.partitions, "version")
    if days is None:
        version, alone = 0, True
        _no_days(spark, store).write.mode("overwrite").parquet(store.processed(_CURRENT))
    else:
        version = 1 + (_markers(spark, store, _CURRENT).agg(F.max("version")).first()[0] or 0)
        held = _of_days(read(spark, store, "states_delivery_analytics"), store, touched, days).select(*_days(store), "batch").distinct()
        alone = held.groupBy(*_days(store)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    for name, summary in partials.SUMMARIES.items():
        parts = _of_days(read(spark, store, f"states_{name}"), store, touched, days)
        out = partials.finished(summary, parts if alone else partials.merged(summary, parts))
        # States that are not merged come folder by folder, and leave so.
        zones.write_zone(out.withColumn("version", F.lit(version).cast("long")), store.processed(name), folders,
                         rebuild=days is None, rebalance=not alone and not _few_folders(store))
    if days is not None:
        days.withColumn("version", F.lit(version).cast("long")).write.mode("append").parquet(store.processed(_CURRENT))


def _no_days(spark: SparkSession, store) -> DataFrame:
    rows = zones.read_zone(spark, store.processed("unified"), _TYPES).limit(0)
    return rows.select(*_days(store), F.lit(0).cast("long").alias("version"))


def _of_days(rows: DataFrame, store, touched: list | None, days: DataFrame | None) -> DataFrame:
    if days is None:
        return rows
    rows = _in_folders(rows, store, touched)
    return rows.alias("r").join(days.alias("d"), _same("r", "d", _days(store)), "left_semi")


def _in_folders(rows: DataFrame, store, touched: list | None) -> DataFrame:
    """A filter on the folder columns alone, so other folders are not read."""
    if touched is None:
        return rows
    any_of = F.lit(False)
    for folder in touched:
        one = F.lit(True)
        for c in store.partitions:
            one = one & (F.col(c).isNull() if folder[c] is None else F.col(c) == F.lit(folder[c]))
        any_of = any_of | one
    return rows.filter(any_of)


def rebuild(unified: DataFrame, store) -> None:
    """All tables from deduplicated rows, as batch 0; whatever was there goes."""
    spark = unified.sparkSession
    zones.write_zone(_dated(unified).withColumn("batch", F.lit(0).cast("long")), store.processed("unified"), _folders(store), rebuild=True,
                     rebalance=not _few_folders(store))
    stored = zones.read_zone(spark, store.processed("unified"), _TYPES)
    stored.select(*store.partitions, "batch").limit(0).write.mode("overwrite").parquet(store.processed(_MARK))
    _write_states(stored, store, rebuild=True)
    _write_tables(spark, store)


def refresh(rows: DataFrame, store, batch: int) -> dict[str, int]:
    """Adds canonical ``rows`` (new files, late rows, copies of stored ones) as ``batch``, a number above 0 that no other rows
    had.  Returns how many rows were new, and how many folders were touched and written anew.

    The driver reads the names of the touched folders, as it does to plan any scan of them."""
    if batch < 1:
        raise ValueError("batch 0 is the full run")
    spark, parts = rows.sparkSession, store.partitions
    new = zones.stored(_dated(normalise.deduplicate(normalise.select_canonical(rows))), "new-rows")
    days = zones.stored(new.select(*_days(store)).distinct(), "touched-days")
    touched = days.select(*parts).distinct().collect()
    if not touched:
        return {"new": 0, "touched": 0, "rewritten": 0}
    everything = zones.read_zone(spark, store.processed("unified"), _TYPES)
    before = _in_folders(_counting(spark, store, everything.filter(F.col("batch") != batch), but=batch), store, touched).select(new.columns)
    # The key has the time, so copies are of the same day.
    before_days = before.alias("a").join(days.select("date").distinct().alias("d"), _same("a", "d", ("date",)), "left_semi")
    number = F.lit(batch).cast("long")
    fresh, first, rewritten = new, None, []
    if not before_days.isEmpty():
        # Copies: stored rows whose key comes again, beside the new ones.
        again = zones.stored(before_days.alias("a").join(new.select(*DEDUP_KEY).alias("b"), _same("a", "b", DEDUP_KEY), "left_semi"), "stored-copies")
        both = again.withColumn("is_new", F.lit(False)).unionByName(
            new.alias("a").join(again.select(*DEDUP_KEY).alias("b"), _same("a", "b", DEDUP_KEY), "left_semi").withColumn("is_new", F.lit(True)))
        # ``is_new`` comes last in the order of columns: of equal copies the stored one stays.
        first = zones.stored(normalise.deduplicate(both), "copies")
        replaced = zones.stored(first.filter("is_new").select(*parts).distinct(), "rewritten-folders")
        fresh = new.alias("a").join(first.select(*DEDUP_KEY).alias("b"), _same("a", "b", DEDUP_KEY), "left_anti")
        rewritten = replaced.collect()
    if rewritten:
        old = _in_folders(before, store, rewritten)
        whole = old.alias("a").join(first.filter("is_new").select(*DEDUP_KEY).alias("b"), _same("a", "b", DEDUP_KEY), "left_anti")
        fresh = zones.stored(fresh.unionByName(first.filter("is_new").drop("is_new")).unionByName(whole), "added-rows")
    zones.write_zone(fresh.withColumn("batch", number), store.processed("unified"), _folders(store), rebalance=not _few_folders(store))
    written = zones.read_zone(spark, store.processed("unified"), _TYPES).filter(F.col("batch") == batch)
    _write_states(_in_folders(written, store, touched), store, rebuild=False)
    if rewritten:
        replaced.withColumn("batch", number).write.mode("append").parquet(store.processed(_MARK))
    _write_tables(spark, store, touched, days)
    return {"new": fresh.count() if not rewritten else new.count() - first.filter("NOT is_new").count(),
            "touched": len(touched), "rewritten": len(rewritten)}
