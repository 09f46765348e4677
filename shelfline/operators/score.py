"""Weighted ranking of platforms for every pack at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline import fixed_values as fv
from shelfline.functions.joins import null_safe_join
from shelfline.functions.numbers import RATING, col, exact_avg, round_half_up
from shelfline.operators.trend import SERIES
from shelfline.schema import PACK_KEY

THIRD = 1 / 3


def weight_columns(price, delivery, quality) -> dict[str, Column]:
    """Slider values (numbers or columns) as weights that sum to one; all zero: a third each."""
    price, delivery, quality = (c if isinstance(c, Column) else F.lit(c) for c in (price, delivery, quality))
    total = price + delivery + quality
    return {name: F.when(total == 0, F.lit(THIRD)).otherwise(F.try_divide(value, total))
            for name, value in (("w_price", price), ("w_delivery", delivery), ("w_quality", quality))}


def normalise_weights(profiles: DataFrame, price: str, delivery: str, quality: str) -> DataFrame:
    return profiles.withColumns(weight_columns(F.col(price), F.col(delivery), F.col(quality)))


def relative_score(value: Column | str, over) -> Column:
    """1 for the lowest value of the group, 0 for the highest, 1 for all if they are equal."""
    low, high = F.min(col(value)).over(over), F.max(col(value)).over(over)
    return F.when(high == low, F.lit(1.0)).otherwise(
        F.lit(1.0) - (col(value) - low) / F.nullif(high - low, F.lit(0)))


def with_defaults(latest: DataFrame, availability: DataFrame) -> DataFrame:
    """Latest listings plus the recent availability of product and platform, defaults filled in."""
    rows = null_safe_join(latest, availability, SERIES, "left")
    return rows.withColumns({
        "availability_rate_7d": F.coalesce("availability_rate_7d", F.lit(fv.DEFAULT_AVAILABILITY)),
        "in_stock": F.coalesce("in_stock", F.lit(True)),
        "price_per_unit": F.coalesce("price_per_unit", "effective_price"),
    })


def impute_rating(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Missing rating -> average rating of the platform, over ``history`` if given.

    The averages are one row per platform, read as a scalar map, so the listings are not shuffled
    and a platform that holds most rows is no hot key.  Rows without a platform have no average."""
    means = (df if history is None else history).filter("platform is not null").groupBy("platform").agg(
        exact_avg("rating", RATING).alias("mean"))
    lookup = means.agg(F.map_from_entries(F.collect_list(F.struct("platform", "mean")))).scalar()
    return df.withColumn("rating", F.coalesce(F.col("rating"), F.element_at(lookup, F.col("platform"))))


def sub_scores(rows: DataFrame) -> DataFrame:
    """Unrounded price, delivery and quality scores within each pack."""
    pack = Window.partitionBy(*PACK_KEY)
    quality = F.lit(0.5) * (F.col("rating") / F.lit(5.0)) + F.lit(0.5) * F.col("availability_rate_7d")
    return rows.withColumns({
        "_price": relative_score("effective_price", pack),
        "_delivery": relative_score("delivery_minutes", pack),
        "_quality": F.when(F.col("in_stock"), quality).otherwise(F.lit(0.0)),
    })


def composite(w_price: Column, w_delivery: Column, w_quality: Column) -> Column:
    return round_half_up(w_price * F.col("_price") + w_delivery * F.col("_delivery")
                         + w_quality * F.col("_quality"), 4)


def _rounded() -> dict[str, Column]:
    return {f"{name}_score": round_half_up(f"_{name}", 4) for name in ("price", "delivery", "quality")}


def score_platforms(rows: DataFrame, sliders=fv.DEFAULT_WEIGHTS, rank_last_if_unavailable: bool = False) -> DataFrame:
    """Scores and rank of each platform within its pack.  Ordered by the rounded composite, ties by
    platform name; out-of-stock platforms last if asked for."""
    weights = weight_columns(*sliders)
    scored = sub_scores(rows).withColumns(
        {**_rounded(), **weights, "composite_score": composite(*weights.values())})
    order = [F.desc("composite_score"), F.asc("platform")]
    if rank_last_if_unavailable:
        order.insert(0, F.desc("in_stock"))
    rank = F.row_number().over(Window.partitionBy(*PACK_KEY).orderBy(*order))
    return scored.withColumn("rank", rank).drop("_price", "_delivery", "_quality")


def recommend(scored: DataFrame) -> DataFrame:
    """One nested record per pack: winners, the platforms in rank order, and the weights.

    A group has one row per platform, so the array is bounded by the number of platforms."""
    def winner(*by):
        return F.min_by("platform", F.struct(*by, F.col("rank")))

    entry = F.struct("rank", "platform", F.col("effective_price").alias("price"), "price_per_unit",
                     "delivery_minutes", F.col("in_stock").alias("is_available"), "rating",
                     "availability_rate_7d", "price_score", "delivery_score", "quality_score",
                     "composite_score")
    return scored.groupBy(*PACK_KEY).agg(
        F.max("snapshot_time").alias("comparison_time"),
        F.first(F.struct(F.col("w_price").alias("price"), F.col("w_delivery").alias("delivery"),
                         F.col("w_quality").alias("quality"))).alias("user_weights"),
        F.sort_array(F.collect_list(entry)).alias("platforms"),
        F.min_by("platform", "rank").alias("recommended_platform"),
        winner(F.col("effective_price")).alias("best_price_platform"),
        winner(F.col("price_per_unit")).alias("best_unit_price_platform"),
        winner(F.col("delivery_minutes")).alias("fastest_delivery_platform"),
        winner(-F.col("quality_score")).alias("highest_quality_platform"),
    ).withColumn("only_here", F.size("platforms") == 1)


def answer_text(records: DataFrame, names: DataFrame, location: str, product: str = "product_name",
                pack: Column | None = None) -> DataFrame:
    """Adds ``sentence``: the recommendation in words; says so where there is no record."""
    def entry_of(platform: str) -> Column:
        return F.get(F.filter("platforms", lambda p: p["platform"] == F.col(platform)), F.lit(0))

    small = F.broadcast(names)
    won = small.select(F.col("platform").alias("recommended_platform"), F.col("display_name").alias("_won"))
    low = small.select(F.col("platform").alias("best_price_platform"), F.col("display_name").alias("_low"))
    rows = records.join(won, "recommended_platform", "left").join(low, "best_price_platform", "left")

    def whole(price: Column) -> Column:
        return F.bround(price, 0).cast("bigint").cast("string")

    best, cheap = entry_of("recommended_platform"), entry_of("best_price_platform")
    label = F.concat(F.lit(" "), F.col("pack_size").cast("string"), "pack_unit") if pack is None else pack
    found = _fill(fv.ANSWER_FOUND, product=F.col(product), pack=F.coalesce(label, F.lit("")),
                  location=F.lit(location), platform=F.coalesce("_won", "recommended_platform"),
                  price=whole(best["price"]), minutes=best["delivery_minutes"].cast("string"),
                  rating=F.format_string("%.1f", F.bround(best["rating"], 1)))
    cheaper = _fill(fv.ANSWER_CHEAPER, platform=F.coalesce("_low", "best_price_platform"),
                    price=whole(cheap["price"]))
    none = _fill(fv.ANSWER_NONE, product=F.coalesce(product, F.lit("that product")))
    text = F.when(F.col("recommended_platform").isNull(), none).when(
        F.col("best_price_platform") == F.col("recommended_platform"), found).otherwise(F.concat(found, cheaper))
    return rows.withColumn("sentence", text).drop("_won", "_low")


def _fill(wording: str, **values: Column) -> Column:
    """``"a {x} b"`` with the columns put in."""
    parts = []
    for piece in wording.split("{"):
        name, brace, rest = piece.partition("}")
        if not brace:
            parts.append(F.lit(piece))
        else:
            parts += [values[name], F.lit(rest)]
    return F.concat(*parts)


def weight_sensitivity(rows: DataFrame, profiles: dict[str, tuple[int, int, int]]) -> DataFrame:
    """The winner of each pack under each named slider setting.  The settings are constants,
    attached to the scored rows by an explode, and the scores are computed once."""
    options = F.array(*[
        F.struct(F.lit(name).alias("profile"), *[w.alias(n) for n, w in weight_columns(*sliders).items()])
        for name, sliders in profiles.items()])
    wide = sub_scores(rows).withColumn("_o", F.explode(options))
    score = composite(F.col("_o.w_price"), F.col("_o.w_delivery"), F.col("_o.w_quality"))
    best = F.min(F.struct((-score).alias("negative"), F.col("platform"))).alias("w")
    return wide.groupBy(*PACK_KEY, F.col("_o.profile").alias("profile")).agg(best).select(
        *PACK_KEY, "profile", F.col("w.platform").alias("winner"), (-F.col("w.negative")).alias("composite_score"))


def stockout_risk(df: DataFrame, latest: DataFrame, end: Column, hours: int = 168,
                  limits=fv.STOCKOUT_HOURS) -> DataFrame:
    """Hours of cover: current stock of product and platform over its recent hourly sales."""
    recent = df.filter((F.col("snapshot_time") > end - F.make_dt_interval(F.lit(0), F.lit(hours)))
                       & (F.col("snapshot_time") <= end))
    sold = recent.groupBy(*SERIES).agg(F.sum("units_ordered").alias("units"))
    stock = latest.groupBy(*SERIES).agg(F.sum("stock_remaining").alias("stock"))
    rows = null_safe_join(stock, sold, SERIES, "left").withColumn("units", F.coalesce("units", F.lit(0)))
    cover = F.try_divide(F.col("stock") * F.lit(hours), F.col("units"))
    risk = F.when((F.col("stock") == 0) | (cover < limits[0]), "high").when(cover < limits[1], "medium").otherwise("low")
    return rows.withColumns({"hours_of_cover": cover, "stockout_risk": risk})


def demand_alerts(latest: DataFrame, predicted: DataFrame, hours: int = fv.STOCKOUT_HOURS[0]) -> DataFrame:
    """Products that are predicted to run out within ``hours``: stock of product and platform over the demand predicted
    for the next day (``predicted_demand_index``).  Without a prediction only an empty stock gives an alert."""
    stock = latest.groupBy(*SERIES).agg(F.sum("stock_remaining").alias("stock"))
    rows = null_safe_join(stock, predicted.select(*SERIES, "predicted_demand_index"), SERIES, "left")
    cover = F.try_divide(F.col("stock") * F.lit(24.0), F.col("predicted_demand_index"))
    alert = F.coalesce((F.col("stock") <= 0) | (cover < hours), F.lit(False))
    return rows.select(*SERIES, "stock", "predicted_demand_index", cover.alias("predicted_hours_of_cover"), alert.alias("demand_alert"))
