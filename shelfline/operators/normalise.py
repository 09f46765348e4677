"""Vendor feeds -> one canonical, deduplicated table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfline.functions.listing import first_int, parse_time, word_is
from shelfline.schema import CANONICAL, DEDUP_KEY, Feed


def read_feed(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    return spark.read.schema(feed.raw_schema()).parquet(path)


def normalise_feed(raw: DataFrame, feed: Feed, platform: str) -> DataFrame:
    """One projection: rename, convert, add the platform; columns the feed lacks become typed nulls."""
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    source = {name: c for c, name in feed.columns.items() if c in kinds}
    out = []
    for field in CANONICAL.fields:
        if field.name == "platform":
            value = F.lit(platform)
        elif field.name not in source:
            value = F.lit(None).cast(field.dataType)
        else:
            value = _convert(source[field.name], kinds[source[field.name]], field, feed)
        out.append(value.alias(field.name))
    return raw.select(*out)


def _convert(column: str, kind: T.DataType, field: T.StructField, feed: Feed) -> Column:
    value = F.col(column)
    if field.name == "in_stock" and feed.stock_word:
        return word_is(value, feed.stock_word)
    if field.name == "delivery_minutes" and feed.minutes_text:
        return first_int(value)
    if field.name == "snapshot_time" and isinstance(kind, T.StringType):
        return parse_time(value)
    if kind == field.dataType:
        return value
    return value.try_cast(field.dataType)


def select_canonical(df: DataFrame) -> DataFrame:
    """Canonical columns in canonical order and type; missing ones as typed nulls, others dropped."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in CANONICAL.fields])


def unify(frames: list[DataFrame]) -> DataFrame:
    """Union by name; keeps duplicates."""
    return reduce(DataFrame.unionByName, [select_canonical(f) for f in frames])


def deduplicate(df: DataFrame, keys: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """One row per key.  Copies that differ are ordered by all other columns, so the survivor
    does not depend on partitioning.  ``row_number = 1`` is applied per input partition before
    the shuffle as well, so a key with very many copies sends few of them."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*rest)
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def duplicate_audit(df: DataFrame, keys: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """Rows, distinct keys and surplus rows per platform."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("platform").agg(
        F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))
