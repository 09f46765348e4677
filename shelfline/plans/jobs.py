"""End-to-end batch jobs over stored tables.

Each job reads what an earlier one wrote.  A written table is also where lineage ends: a lost
executor re-reads it instead of recomputing the feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.operators import conformal, envelope, forecast, latest, models, normalise, partials, quality, score, textjobs, trend
from shelfline.plans import refresh
from shelfline.plans.refresh import Store
from shelfline.schema import Feed
from shelfline.sources import zones
from shelfline.sources.dimensions import platform_names

AGGREGATES = tuple(partials.SUMMARIES)


def _union(spark: SparkSession, feeds: dict[str, tuple[str, Feed]]) -> DataFrame:
    return normalise.unify([normalise.normalise_feed(normalise.read_feed(spark, path, feed), feed, platform)
                            for platform, (path, feed) in feeds.items()])


def preprocess(spark: SparkSession, feeds: dict[str, tuple[str, Feed]], store: Store) -> dict[str, dict]:
    """Raw feeds -> unified table -> the aggregate tables with their states, and the gaps of every pack on every
    platform; all from the start.  ``feeds``: platform -> (path, layout).

    Row counts are observed during the write; the aggregates scan only the columns they need of
    the stored table.  Returns the counts before and after deduplication."""
    before, after = Observation("union"), Observation("unified")
    union = quality.observed(_union(spark, feeds), before)
    refresh.rebuild(quality.observed(normalise.deduplicate(union), after), store)
    zones.write_zone(latest.pack_gaps(load_unified(spark, store), tuple(feeds)), store.processed("slot_gaps"), ("platform",), rebuild=True)
    return {"union": before.get, "unified": after.get}


def preprocess_batch(spark: SparkSession, feeds: dict[str, tuple[str, Feed]], store: Store, batch: int) -> dict[str, int]:
    """New raw files, of whatever days, into the tables of :func:`preprocess`; only the folders of their rows change.
    The gaps of packs are left to the full run."""
    return refresh.refresh(_union(spark, feeds), store, batch)


def load_unified(spark: SparkSession, store: Store) -> DataFrame:
    return normalise.select_canonical(refresh.read(spark, store, "unified"))


def load_recent(spark: SparkSession, store: Store, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the last days' folders; which these are, the summaries of the folders tell, where batches were written."""
    rows = refresh.read(spark, store, "unified")
    end = refresh.newest(spark, store) if as_of is None and "batch" in rows.columns else as_of
    return normalise.select_canonical(zones.recent(rows, days, end))


def train(spark: SparkSession, store: Store, location: str, demand: dict | None = None,
          trends: dict | None = None, horizons: dict | None = None) -> dict[str, dict]:
    """Fits, evaluates, saves and applies all models: demand of a listing, trends, and demand one and three days ahead, from
    which the forecast records are made.  Returns their test scores."""
    listings = load_unified(spark, store)
    rows = models.ml_features(listings)
    demand_model, predicted = models.split_and_fit(rows, models.fit_demand_model, **(demand or {}))
    errors = forecast.forecast_errors(predicted, "units_ordered", "prediction").first()
    demand_model.write().overwrite().save(store.model("demand"))
    out = models.forecast_demand(demand_model, rows, location)
    zones.write_zone(out, store.curated("demand_forecasts"), store.partitions, rebuild=True)

    labels = trend.trend_labels(rows)
    trend_model, predicted = models.split_and_fit(labels, models.fit_trend_model, **(trends or {}))
    scores = forecast.classification_scores(forecast.confusion(predicted)).first()
    trend_model.write().overwrite().save(store.model("trend"))
    zones.write_zone(models.classify_trends(trend_model, labels, location), store.curated("trend_labels"),
                     store.partitions, rebuild=True)
    last = zones.stored(trend.latest_trends(models.predicted_trends(trend_model, labels)), "last-trends")
    zones.write_zone(trend.ranked_trending(last), store.curated("trending"), partitions=(), rebuild=True)

    end = refresh.newest(spark, store)
    ahead = train_horizons(store, rows, **(horizons or {}))
    newest = latest.latest_snapshot(listings)
    records = zones.stored(forecast.model_records(
        spark.read.parquet(store.curated("horizon_predictions")), last, score.stockout_risk(listings, newest, end), end, location,
        fv.DEMAND_MODEL_VERSION, HORIZON_GRAIN), "records")
    zones.write_zone(records, store.curated("forecast_records"), partitions=(), rebuild=True)
    zones.write_zone(score.demand_alerts(newest, _of_day(records)), store.curated("demand_alerts"), partitions=(), rebuild=True)
    return {"demand": errors.asDict(), "trend": scores.asDict(), "horizons": ahead}


HORIZON_GRAIN = ("product_name", "category", "platform")
# A series' own errors, else those of its platform, else all.
INTERVAL_LEVELS = {"series": HORIZON_GRAIN, "platform": ("platform",), "all": ()}


def _of_day(records: DataFrame) -> DataFrame:
    """Demand predicted for the next day, per product and platform."""
    return records.filter(F.col("forecast_horizon_hours") == 24).groupBy("product_name", "platform").agg(
        F.sum("predicted_demand_index").alias("predicted_demand_index"))


def train_horizons(store: Store, rows: DataFrame, miss: float = conformal.MISS, **settings) -> dict[str, dict]:
    """One model per horizon, fitted on the training months; bounds from its errors in the test month; both are saved, and
    the predictions of all days with their bounds.

    Returns per horizon the errors of the test month, and the share of days of all other months (neither fitted nor used for the
    bounds) whose demand lay between the bounds."""
    table = zones.stored(forecast.horizon_table(forecast.demand_series(rows, HORIZON_GRAIN), HORIZON_GRAIN), "horizons")
    train, _ = forecast.time_split(table)
    fitted = {h: models.fit_horizon_model(train, h, HORIZON_GRAIN, **settings) for h in forecast.HORIZONS}
    for h, model in fitted.items():
        model.write().overwrite().save(store.model(f"demand_{h}"))
    ahead = zones.stored(forecast.long_predictions(models.predict_horizons(fitted, table)), "horizon-predictions")
    held = ahead.filter((F.col("month") == fv.TEST_MONTH) & F.col("actual").isNotNull())
    bounds = conformal.error_bounds(held.withColumn("error", F.col("actual") - F.col("predicted")), INTERVAL_LEVELS, ("horizon",), miss=miss)
    bounds.write.mode("overwrite").parquet(store.model("horizon_bounds"))
    bounds = rows.sparkSession.read.parquet(store.model("horizon_bounds"))
    zones.write_zone(conformal.with_bounds(ahead, bounds, INTERVAL_LEVELS, ("horizon",)), store.curated("horizon_predictions"),
                     partitions=(), rebuild=True)
    done = rows.sparkSession.read.parquet(store.curated("horizon_predictions"))
    others = conformal.coverage(done.filter(~F.col("month").isin(*fv.TRAIN_MONTHS, fv.TEST_MONTH)), "actual", ("horizon",)).collect()
    covered = {r["horizon"]: r["coverage"] for r in others}
    return {h: {**forecast.forecast_errors(held.filter(F.col("horizon") == h), "actual", "predicted").first().asDict(),
                "coverage": covered.get(h)} for h in fitted}


def compare(spark: SparkSession, store: Store, sliders=fv.DEFAULT_WEIGHTS, as_of: Column | None = None) -> None:
    """Ranks the platforms of every pack and stores the nested records, and the ranges of each slider that a platform wins, so
    that a moved slider is a lookup; also the risk of running out of stock.

    The latest rows come from the whole table, since a pack may not have been listed for long;
    availability reads the last days only."""
    rows = load_unified(spark, store)
    current = zones.stored(latest.latest_snapshot(rows, as_of), "latest")
    end = current.agg(F.max("snapshot_time")).scalar() if as_of is None else as_of
    recent = load_recent(spark, store, 7, as_of)
    available = trend.availability_7d(recent, end)
    zones.write_zone(score.stockout_risk(recent, current, end), store.curated("stockout_risk"), partitions=())
    scorable = zones.stored(score.with_defaults(score.impute_rating(current, rows), available), "scorable")
    zones.write_zone(envelope.winner_ranges(scorable, sliders), store.curated("slider_ranges"), partitions=())
    records = score.recommend(score.score_platforms(scorable, sliders))
    zones.write_zone(records, store.curated("platform_comparison"), partitions=())


def answer(spark: SparkSession, store: Store, questions: DataFrame, catalogue: DataFrame,
           aliases: dict[str, tuple[str, ...]], names: dict[str, str], location: str) -> DataFrame:
    """Answers a table of questions (question_id, text), short and as a sentence."""
    records = spark.read.parquet(store.curated("platform_comparison"))
    rows = load_unified(spark, store)
    parsed = textjobs.parse_questions(questions, catalogue, aliases)
    short = textjobs.answer_questions(parsed, records, latest.latest_snapshot(rows),
                                      trend.top_trending(trend.trend_labels(rows)))
    size, unit = textjobs.normal_pack(F.col("pack_size"), F.col("pack_unit"))
    kept = [c for c in records.columns if c not in ("product_name", "pack_size", "pack_unit")]
    chosen = records.groupBy(F.col("product_name").alias("product"), size.alias("_size"), unit.alias("_unit")).agg(
        F.min_by(F.struct("pack_size", "pack_unit", *kept), F.struct("pack_size", "pack_unit")).alias("r"))
    short = short.withColumnsRenamed({"pack_size": "_size", "pack_unit": "_unit"})
    found = short.join(chosen, ["product", "_size", "_unit"], "left").select("*", "r.*").drop("r")
    return score.answer_text(found, platform_names(spark, names), location, product="product").select(
        "question_id", "intent", "product", "pack_size", "pack_unit", "platforms_named", "answer", "sentence")
