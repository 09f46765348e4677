"""Listings made from the order and part tables (FIXTURES.md, section 2).

Every column is a deterministic expression of the input, so the work grows with the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.functions.listing import is_peak, is_weekend, unit_price
from shelfline.operators.enrich import add_festival, add_season, add_weather
from shelfline.schema import CANONICAL, FEED_A, FEED_B, FEED_C, Feed
from shelfline.sources.dimensions import seasonal_table, weather_table

LOCATION = "Old Town"
FEEDS: dict[str, Feed] = {"alpha": FEED_A, "beta": FEED_B, "gamma": FEED_C}
PLATFORMS = tuple(FEEDS)
DISPLAY_NAMES = {"alpha": "Alpha", "beta": "Beta", "gamma": "Gamma Mart"}
PLATFORM_ALIASES = {"alpha": ("alpha",), "beta": ("beta",), "gamma": ("gamma", "mart")}
PREMIUM_CATEGORIES = ("red", "blue")
# The test products take the three seasonal curves in turn.
SEASONS = dict(zip(("red widget", "blue bolt", "hot gear"), fv.SEASONAL_FACTORS.values()))

_LINEITEM = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_shipdate")


def listings(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Listing rows without the calendar and weather columns; ``lineitem`` may be a stream."""
    if lineitem is None:
        lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", F.col("p_name").alias("product_name"),
        F.substring_index("p_name", " ", 1).alias("category"),
        F.col("p_size").cast("int").alias("pack_size"),
        F.when(F.col("p_partkey") % 2 == 0, "g").otherwise("ml").alias("pack_unit"))
    rows = lineitem.select(*_LINEITEM).join(part, F.col("l_partkey") == F.col("p_partkey"))
    hour = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5) % 24).cast("int")
    minute = (F.lit(15) * ((F.col("l_orderkey") + F.col("l_partkey")) % 4)).cast("int")
    stock = (F.col("l_partkey") * 31 + F.col("l_orderkey") * 17 + F.col("l_linenumber")) % 50 - 5
    rating = F.lit(10) + (F.col("l_partkey") * 7 + F.col("l_suppkey") * 3 + F.col("l_linenumber")) % 41
    first = rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("record_id"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), hour, minute)).cast("timestamp")
        .alias("snapshot_time"),
        hour.alias("hour_of_day"),
        F.lit(LOCATION).alias("location"),
        "product_name", "category", "pack_size", "pack_unit",
        F.when(F.col("l_suppkey") % 3 == 0, "alpha").when(F.col("l_suppkey") % 3 == 1, "beta")
        .otherwise("gamma").alias("platform"),
        F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).alias("mrp_cents"),
        F.round(F.col("l_discount") * 100, 0).cast("int").alias("discount"),
        F.greatest(F.lit(0), stock).cast("int").alias("stock_remaining"),
        (F.lit(7) + (F.col("l_orderkey") * 13 + F.col("l_suppkey") * 7) % 54).cast("int")
        .alias("delivery_minutes"),
        (rating / F.lit(10.0)).alias("rating"),
    )
    second = first.withColumns({
        "eff_cents": F.floor(F.col("mrp_cents") * (F.lit(100) - F.col("discount")) / F.lit(100.0)),
        "in_stock": F.col("stock_remaining") > 0,
        "is_weekend": is_weekend("snapshot_time"),
        "is_peak_hour": is_peak("hour_of_day"),
        "month": F.month("snapshot_time"),
        "mrp": F.col("mrp_cents") / F.lit(100.0),
        "discount_pct": F.col("discount").cast("double"),
    })
    third = second.withColumns({
        "units_ordered": F.when(F.col("in_stock"), F.least(F.col("l_quantity").cast("int"),
                                                           "stock_remaining")).otherwise(F.lit(0)),
        "effective_price": F.col("eff_cents") / F.lit(100.0),
    })
    return third.withColumns({
        "revenue_inr": F.col("eff_cents") * F.col("units_ordered") / F.lit(100.0),
        "price_per_unit": unit_price("effective_price", "pack_size"),
    })


def enriched(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Listings with weather, season and festival columns: all canonical columns."""
    rows = listings(spark, sf_dir) if base is None else base
    rows = add_weather(rows, weather_table(spark))
    rows = add_season(rows, seasonal_table(spark, SEASONS))
    rows = add_festival(rows)
    rain_percent = F.rint(F.col("rain_probability") * 100)
    return rows.withColumns({
        "is_raining": (F.col("l_orderkey") % 100) < rain_percent,
        "bulk_discount_pct": (F.col("pack_size") % 5) / F.lit(100.0),
    })


def unified_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical table as the preprocessing job leaves it."""
    return enriched(spark, sf_dir).select(*CANONICAL.names)


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same listings in the three raw layouts, with defects: orders divisible by 97 come
    twice, and feed C has the delivery time 'n/a' for orders divisible by 1009."""
    rows = enriched(spark, sf_dir)
    copies = F.when(F.col("l_orderkey") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_copy", F.explode(copies)).drop("_copy")
    return {name: _to_raw(rows.filter(F.col("platform") == name), feed) for name, feed in FEEDS.items()}


def _to_raw(rows: DataFrame, feed: Feed) -> DataFrame:
    kinds = {f.name: f.dataType for f in feed.raw_schema().fields}
    out = []
    for raw, name in feed.columns.items():
        value = F.col(name)
        if name == "snapshot_time":
            value = F.date_format(value, fv.RAW_TIME_FORMAT)
        elif name == "in_stock" and feed.stock_word == fv.FEED_A_STOCK_WORD:
            value = F.when(value, feed.stock_word).otherwise("out_of_stock")
        elif name == "in_stock" and feed.stock_word:
            value = F.when(value, feed.stock_word).otherwise("no")
        elif name == "delivery_minutes" and feed.minutes_text:
            value = F.when(F.col("l_orderkey") % 1009 == 0, "n/a").otherwise(
                F.concat(value.cast("string"), F.lit(" mins")))
        out.append(value.cast(kinds[raw]).alias(raw))
    labels = (F.concat(F.col("pack_size").cast("string"), "pack_unit"),
              F.date_format("snapshot_time", "EEEE"))
    return rows.select(*out, *[v.alias(c) for c, v in zip(feed.dropped, labels)])


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question texts: all conversation turns, and one written question per part."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = turns.select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("question_id"), "text")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    size = F.col("p_size").cast("string")
    name = F.col("p_name")
    forms = [
        F.concat(F.lit("Where can we get "), name, F.lit(" tonight?")),
        F.concat(F.lit("Lowest price for "), size, F.lit(" g "), name, F.lit(" please")),
        F.concat(F.lit("How long until "), name, F.lit(" arrives on Gamma?")),
        F.lit("What is popular this week?"),
        F.concat(name, F.lit(": Alpha or Gamma?")),
        F.concat(F.lit("side  by side "), F.upper(name), F.lit(" "), size, F.lit("pcs")),
        F.concat(F.lit("Any budget "), F.split_part(name, F.lit(" "), F.lit(1)), F.lit(" things")),
        F.concat(F.lit("I need "), name, F.lit(" "), size, F.lit(" kg")),
    ]
    asked = part.select(
        F.concat_ws("-", F.lit("p"), F.col("p_partkey").cast("string")).alias("question_id"),
        F.element_at(F.array(*forms), (F.col("p_partkey") % len(forms) + 1).cast("int")).alias("text"))
    return said.unionByName(asked)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_name").alias("product_name")).distinct()


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
