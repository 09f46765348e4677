"""Calendar, weather, season and pack enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.functions.listing import bulk_factor
from shelfline.functions.numbers import round_half_up


def add_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Label, rain probability and delay of the row's month."""
    return df.join(F.broadcast(weather), "month", "left")


def add_season(df: DataFrame, seasons: DataFrame) -> DataFrame:
    joined = df.join(F.broadcast(seasons), ["product_name", "month"], "left")
    return joined.withColumn("seasonal_factor", F.coalesce("seasonal_factor", F.lit(1.0)))


def add_festival(df: DataFrame, festivals=fv.FESTIVALS, when: Column | str = "snapshot_time") -> DataFrame:
    """Factors of the festival that the row's day belongs to, 1 on other days, in any year.

    The few festivals become part of the projection: a day's distance from each one's start in the
    day's own year.  Where festivals overlap the first listed one holds, and a festival does not
    run on into the next year."""
    day = F.to_date(when)
    demand = price = F
    for month, first, demand_mult, price_mult, length in festivals:
        start = F.make_date(F.year(day), F.lit(month), F.lit(first))
        held = F.datediff(day, start).between(0, length - 1)
        demand, price = demand.when(held, F.lit(demand_mult)), price.when(held, F.lit(price_mult))
    plain = F.lit(1.0)
    return df.withColumns({
        "festival_demand_mult": plain if demand is F else demand.otherwise(plain),
        "festival_price_mult": plain if price is F else price.otherwise(plain),
    })


def explode_packs(products: DataFrame) -> DataFrame:
    """``products`` has ``base_size``, ``pack_unit`` and the array ``pack_sizes``: one row per size."""
    largest = F.when(F.size("pack_sizes") > 1, F.array_max("pack_sizes")).otherwise(F.col("base_size"))
    rows = products.withColumn("largest_size", largest).withColumn("pack_size", F.explode("pack_sizes"))
    return rows.withColumns({
        "pack_label": F.concat(F.col("pack_size").cast("string"), "pack_unit"),
        "size_ratio": F.col("pack_size") / F.col("base_size"),
    }).drop("pack_sizes")


def add_bulk_discount(packs: DataFrame) -> DataFrame:
    factor = bulk_factor("pack_size", "base_size", "largest_size")
    return packs.withColumn("bulk_factor", factor).withColumn(
        "bulk_discount_pct", round_half_up(F.lit(1.0) - F.col("bulk_factor"), 3))
