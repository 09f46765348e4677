"""Aggregate tables over the canonical listings.

All measures are sums, counts, minima and maxima of fixed-point integers, so each aggregate is
combined before its shuffle and a hot product or platform sends one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions.numbers import (MONEY, PERCENT, RATING, UNIT_PRICE, exact_avg, exact_sum,
                                         scaled_sum, share)
from shelfline.operators import partials


def day():
    return F.to_date("snapshot_time").alias("date")


def row_count():
    return F.count(F.lit(1)).alias("record_count")


def price_analytics(df: DataFrame) -> DataFrame:
    """Hourly prices of one pack on one platform."""
    hour = F.col("hour_of_day").alias("hour")
    return df.groupBy("product_name", "category", "platform", day(), hour, "pack_size", "pack_unit").agg(
        exact_avg("effective_price", MONEY).alias("avg_price"),
        F.min("effective_price").alias("min_price"),
        F.max("effective_price").alias("max_price"),
        exact_avg("price_per_unit", UNIT_PRICE).alias("avg_price_per_unit"),
        exact_avg("discount_pct", PERCENT).alias("avg_discount_pct"),
        F.stddev_samp("effective_price").alias("price_stddev"),
        row_count())


def delivery_analytics(df: DataFrame) -> DataFrame:
    return df.groupBy("platform", day(), "hour_of_day", "is_weekend", "weather", "is_raining").agg(
        F.avg("delivery_minutes").alias("avg_delivery_mins"),
        F.min("delivery_minutes").alias("min_delivery_mins"),
        F.max("delivery_minutes").alias("max_delivery_mins"),
        row_count())


def revenue_analytics(df: DataFrame) -> DataFrame:
    return df.groupBy("product_name", "category", "platform", day(), "pack_size").agg(
        exact_sum("revenue_inr", MONEY).alias("total_revenue"),
        F.sum("units_ordered").alias("total_units_ordered"),
        F.avg("units_ordered").alias("avg_units_ordered"),
        row_count())


def stock_analytics(df: DataFrame) -> DataFrame:
    return df.groupBy("product_name", "category", "platform", day(), "hour_of_day", "is_peak_hour").agg(
        F.avg(F.col("in_stock").cast("int")).alias("availability_rate"),
        F.count_if(~F.col("in_stock")).alias("stockout_count"),
        F.avg("stock_remaining").alias("avg_stock_remaining"),
        row_count())


def daily_demand(df: DataFrame) -> DataFrame:
    return df.groupBy("product_name", "category", "platform", day(), "month").agg(
        F.sum("units_ordered").alias("daily_demand"),
        exact_avg("effective_price", MONEY).alias("daily_avg_price"))


def hourly_price(parts: DataFrame) -> DataFrame:
    """Product and platform by hour, rolled up from the price states of :mod:`partials`.

    The states carry count and whole sum of the prices that there are, so the roll-up equals the average over the rows."""
    hours = partials.merged(partials.PRICES, parts, ("product_name", "platform", "date", "hour"), only=("price",))
    return hours.select("product_name", "platform", "date", "hour", partials.mean("price", MONEY).alias("avg_price"),
                        F.col("n_rows").alias("record_count"))


def category_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy("category", "platform", day()).agg(
        exact_sum("revenue_inr", MONEY).alias("revenue"), F.sum("units_ordered").alias("units"))


def category_demand_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("category", day()).agg(
        F.sum("units_ordered").alias("units"), F.avg("units_ordered").alias("avg_units"), row_count())


def surge_heatmap(df: DataFrame) -> DataFrame:
    """Average price by product, weekday (1 = Sunday) and hour, over the product's average.
    The window runs over at most 168 pre-aggregated cells per product."""
    cells = df.groupBy("product_name", F.dayofweek("snapshot_time").alias("weekday"), "hour_of_day").agg(
        scaled_sum("effective_price", MONEY).alias("cents"), F.count("effective_price").alias("n"))
    product = Window.partitionBy("product_name")
    mean = F.sum("cents").over(product) / F.sum("n").over(product)
    cell = F.col("cents") / F.col("n")
    return cells.select("product_name", "weekday", "hour_of_day",
                        (cell / F.lit(100.0)).alias("avg_price"), (cell / mean).alias("surge_ratio"))


def seasonal_index(df: DataFrame) -> DataFrame:
    """Month's average price per product, 100 = its average over all months."""
    months = df.groupBy("product_name", "month").agg(
        scaled_sum("effective_price", MONEY).alias("cents"), F.count("effective_price").alias("n"))
    product = Window.partitionBy("product_name")
    mean = F.sum("cents").over(product) / F.sum("n").over(product)
    price = F.col("cents") / F.col("n")
    return months.select("product_name", "month", (price / F.lit(100.0)).alias("avg_price"),
                         (price / mean * F.lit(100.0)).alias("price_index"))


def delivery_contrast(df: DataFrame) -> DataFrame:
    minutes = F.col("delivery_minutes")

    def avg_if(condition):
        return F.avg(F.when(condition, minutes))

    return df.groupBy("platform").agg(
        avg_if(F.col("is_raining")).alias("rain_mins"), avg_if(~F.col("is_raining")).alias("clear_mins"),
        avg_if(F.col("is_weekend")).alias("weekend_mins"), avg_if(~F.col("is_weekend")).alias("weekday_mins"))


def availability_rates(df: DataFrame) -> DataFrame:
    """Availability per platform, stockout share per product, and stockout share in and out of
    peak hours, in one pass: the finest cells first, then grouping sets over those few cells."""
    cells = df.groupBy("platform", "product_name", "is_peak_hour").agg(
        F.count_if("in_stock").alias("stocked"), F.count("in_stock").alias("n"))
    sets = cells.groupingSets([["platform"], ["product_name"], ["is_peak_hour"]],
                              "platform", "product_name", "is_peak_hour")
    out = sets.agg(F.sum("stocked").alias("stocked"), F.sum("n").alias("n"),
                   F.grouping_id().alias("g"))
    grain = F.when(F.col("g") == 3, "platform").when(F.col("g") == 5, "product").otherwise("peak")
    return out.select(
        grain.alias("grain"), "platform", "product_name", "is_peak_hour",
        (F.col("stocked") / F.col("n")).alias("availability_rate"),
        ((F.col("n") - F.col("stocked")) / F.col("n")).alias("stockout_rate"))


def platform_scorecard(df: DataFrame) -> DataFrame:
    return df.groupBy("platform").agg(
        exact_avg("effective_price", MONEY).alias("avg_price"),
        F.avg("delivery_minutes").alias("avg_delivery_mins"),
        exact_avg("rating", RATING).alias("avg_rating"),
        share(F.col("in_stock")).alias("availability_rate"),
        share(F.col("discount_pct") > 0).alias("discount_frequency"),
        row_count())


def weekly_price_index(df: DataFrame) -> DataFrame:
    """Average price per platform and week (Monday), 100 = the platform's first week."""
    weeks = df.groupBy("platform", F.to_date(F.date_trunc("week", "snapshot_time")).alias("week")).agg(
        exact_avg("effective_price", MONEY).alias("avg_price"))
    first = F.first("avg_price").over(Window.partitionBy("platform").orderBy("week"))
    return weeks.withColumn("price_index", F.col("avg_price") / first * F.lit(100.0))


def discount_frequency(df: DataFrame) -> DataFrame:
    return df.groupBy("platform", "category").agg(
        share(F.col("discount_pct") > 0).alias("discount_frequency"), row_count())


def top_revenue_products(df: DataFrame, n: int = 10) -> DataFrame:
    totals = df.groupBy("product_name").agg(exact_sum("revenue_inr", MONEY).alias("revenue"))
    return totals.orderBy(F.desc("revenue"), "product_name").limit(n)
