"""One entry per operator, over the test tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.functions import listing as L
from shelfline.functions.joins import null_safe_join
from shelfline.functions.numbers import round_half_up
from shelfline.operators import aggregate as A
from shelfline.operators import conformal as CF
from shelfline.operators import enrich as E
from shelfline.operators import envelope as EV
from shelfline.operators import forecast as FC
from shelfline.operators import latest as LT
from shelfline.operators import models as M
from shelfline.operators import normalise as N
from shelfline.operators import partials as P
from shelfline.operators import quality as Q
from shelfline.operators import score as S
from shelfline.operators import textjobs as X
from shelfline.operators import trend as TR
from shelfline.operators import usage as U
from shelfline.plans import jobs as J
from shelfline.plans import refresh as RF
from shelfline.plans.refresh import Store
from shelfline.session import new_folder
from shelfline.sources import dimensions as D
from shelfline.sources import testtables as T
from shelfline.sources import zones as Z
from shelfline.streaming import ledger as LG
from shelfline.streaming import replay as ST

QUERIES = {}
PROFILES = {"balanced": (1, 1, 1), "default": fv.DEFAULT_WEIGHTS, "price_only": (100, 0, 0),
            "delivery_only": (0, 100, 0), "quality_only": (0, 0, 100), "unset": (0, 0, 0)}


def query(build):
    """Registers ``build(spark, sf_dir)``; instants leave as wall-clock timestamps in UTC."""
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        out = build(spark, sf_dir)
        return out.select(*[F.col(c).cast("timestamp_ntz") if t == "timestamp" else F.col(c) for c, t in out.dtypes])

    QUERIES[build.__name__] = run
    return run


def _normalised(spark, sf):
    feeds = T.raw_feeds(spark, sf)
    return {p: N.normalise_feed(feeds[p], T.FEEDS[p], p) for p in feeds}


def _unified(spark, sf):
    """Three raw feeds -> normalised -> union -> deduplicated."""
    return N.deduplicate(N.unify(list(_normalised(spark, sf).values())))


def _rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: round_half_up(c, places) for c in columns})


# --- sources and sinks --------------------------------------------------------------------

@query
def write_roundtrip(spark, sf):
    path = new_folder(spark, "unified")
    rows = T.unified_listings(spark, sf).withColumn("year", F.year("snapshot_time"))
    Z.write_zone(rows, path, ("year", "platform"))
    back = Z.read_zone(spark, path)
    return back.groupBy("year", "platform").agg(
        F.count(F.lit(1)).alias("n"), F.sum("units_ordered").alias("units"),
        A.exact_sum("revenue_inr", 2).alias("revenue"))


@query
def partition_pruned_scan(spark, sf):
    path = new_folder(spark, "prices")
    rows = A.price_analytics(T.listings(spark, sf)).withColumn("year", F.year("date"))
    Z.write_zone(rows, path, ("year", "platform"))
    kept = Z.read_zone(spark, path).filter("year = 1999 and platform = 'beta'")
    return kept.groupBy("date").agg(F.sum("record_count").alias("n"), F.min("min_price").alias("min_price"))


@query
def compact_parts(spark, sf):
    parts, merged = new_folder(spark, "parts"), new_folder(spark, "merged")
    T.listings(spark, sf).select(
        "record_id", "snapshot_time", "platform", "units_ordered", "revenue_inr").repartition(40).write.parquet(parts)
    Z.compact(spark, parts, merged)
    back = spark.read.parquet(merged)
    return back.groupBy("platform").agg(
        F.count(F.lit(1)).alias("n"), F.sum("units_ordered").alias("units"),
        A.exact_sum("revenue_inr", 2).alias("revenue")).withColumn(
        "fewer_files", Z.file_count(spark, merged) < Z.file_count(spark, parts))


@query
def sample_500(spark, sf):
    path = new_folder(spark, "sample")
    Z.write_sample(T.listings(spark, sf).select("record_id", "product_name", "platform", "effective_price"), path)
    return spark.read.schema("record_id string, product_name string, platform string, effective_price double").csv(
        path, header=True)


@query
def retention_filter(spark, sf):
    return Z.retention_zones(T.listings(spark, sf).select("record_id", "platform", "snapshot_time"))


@query
def audit_summary(spark, sf):
    union = N.unify(list(_normalised(spark, sf).values()))
    return Q.audit(union, N.deduplicate(union))


@query
def audit_overall(spark, sf):
    """Summaries per day and platform, merged; the estimate of products is held against an exact count."""
    rows = T.listings(spark, sf)
    parts = Z.stored(Q.audit_states(rows, F.to_date("snapshot_time").alias("date"), "platform"), "audit-states")
    exact = rows.rollup("platform").agg(
        (F.grouping("platform") == 1).alias("is_overall"), F.count_distinct("product_name").alias("exact_products"))
    both = null_safe_join(Q.audit_overall(parts), exact, ["platform", "is_overall"], "left")
    near = F.abs(F.col("products") - F.col("exact_products")) <= F.lit(Q.SKETCH_ERROR) * F.col("exact_products")
    return both.withColumn("within_bound", near).drop("products")


# --- normalisation ------------------------------------------------------------------------

@query
def normalise_a(spark, sf):
    return _normalised(spark, sf)["alpha"]


@query
def normalise_b(spark, sf):
    return _normalised(spark, sf)["beta"]


@query
def normalise_c(spark, sf):
    return _normalised(spark, sf)["gamma"]


@query
def canonical_select(spark, sf):
    rows = T.listings(spark, sf).drop("rating", "location").select(
        "units_ordered", "platform", "record_id", "discount", "pack_size", "in_stock")
    return N.select_canonical(rows)


@query
def ml_features(spark, sf):
    rows = T.unified_listings(spark, sf).withColumn(
        "units_ordered", F.when(~(F.col("stock_remaining") == 7), F.col("units_ordered")))
    return M.ml_features(rows).drop("location")


@query
def time_split_counts(spark, sf):
    return FC.time_split_counts(T.listings(spark, sf))


@query
def unit_price(spark, sf):
    rows = T.listings(spark, sf)
    return rows.select("record_id", L.unit_price("effective_price", F.col("pack_size") % 10).alias("price_per_unit"))


@query
def net_price(spark, sf):
    return T.listings(spark, sf).select("record_id", L.net_price("mrp", "discount_pct").alias("net_price"))


@query
def capped_revenue(spark, sf):
    rows = E.add_festival(T.listings(spark, sf))
    units = L.sold_units("l_quantity", "festival_demand_mult", "stock_remaining")
    return rows.withColumn("units", units).select(
        "record_id", "units", L.revenue("effective_price", "units").alias("revenue"))


@query
def lossless_check(spark, sf):
    feeds = T.raw_feeds(spark, sf)
    ids = [feeds[p].select(F.lit(p).alias("platform"), F.col(raw).alias("record_id"))
           for p, feed in T.FEEDS.items() for raw, name in feed.columns.items() if name == "record_id"]
    return Q.lossless_check(T.union_all(ids), _unified(spark, sf))


@query
def dq_violations(spark, sf):
    rows = T.listings(spark, sf).withColumn("rating", F.col("rating") + F.when(F.col("rating") > 4.7, 1.0).otherwise(0.0))
    return Q.rule_violations(rows, Q.domain_rules(T.LOCATION))


@query
def rating_impute(spark, sf):
    rows = T.listings(spark, sf).withColumn("rating", F.when(F.col("l_orderkey") % 11 != 0, F.col("rating")))
    return S.impute_rating(rows.select("record_id", "platform", "rating"))


# --- enrichment ---------------------------------------------------------------------------

@query
def time_band(spark, sf):
    return T.listings(spark, sf).select(
        "record_id", "hour_of_day", L.time_band("hour_of_day").alias("band"), L.is_peak("hour_of_day").alias("peak"))


@query
def seasonal_enrich(spark, sf):
    rows = E.add_season(T.listings(spark, sf), D.seasonal_table(spark, T.SEASONS))
    return rows.select("record_id", "product_name", "month", "seasonal_factor")


@query
def weather_enrich(spark, sf):
    rows = E.add_weather(T.listings(spark, sf), D.weather_table(spark))
    return rows.select("record_id", "month", "weather", "rain_probability", "rain_delay")


@query
def festival_enrich(spark, sf):
    rows = E.add_festival(T.listings(spark, sf))
    return rows.select("record_id", "snapshot_time", "festival_demand_mult", "festival_price_mult")


@query
def weekend_flag(spark, sf):
    return T.listings(spark, sf).select("record_id", L.is_weekend("snapshot_time").alias("weekend"))


def _products(spark, sf):
    """Products with their pack sizes, from the part table."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    return part.groupBy(F.col("p_name").alias("product_name"), F.lit("g").alias("pack_unit")).agg(
        F.min("p_size").alias("low"), F.sort_array(F.collect_set("p_size")).alias("pack_sizes")).select(
        "product_name", "pack_unit", (F.col("low") + 3).alias("base_size"), "pack_sizes")


@query
def pack_explode(spark, sf):
    return E.explode_packs(_products(spark, sf)).select(
        "product_name", "pack_size", "pack_label", "base_size", "largest_size", "size_ratio")


@query
def bulk_discount(spark, sf):
    return E.add_bulk_discount(E.explode_packs(_products(spark, sf))).select(
        "product_name", "pack_size", "bulk_factor", "bulk_discount_pct")


@query
def delivery_adjust(spark, sf):
    rows = T.enriched(spark, sf)
    minutes = L.adjusted_minutes("delivery_minutes", "hour_of_day", "is_weekend", "is_raining", "rain_delay")
    return rows.select("record_id", minutes.alias("adjusted_minutes"))


@query
def weekend_premium(spark, sf):
    return T.listings(spark, sf).select("record_id", L.weekend_premium(
        "is_weekend", "category", "hour_of_day", T.PREMIUM_CATEGORIES).alias("premium"))


@query
def slot_gaps(spark, sf):
    gaps = LT.series_gaps(T.listings(spark, sf), ["category"], T.PLATFORMS, 86400)
    return gaps.select("category", "platform", F.date_from_unix_date(F.col("gap_first").cast("int")).alias("gap_first"),
                       F.date_from_unix_date(F.col("gap_last").cast("int")).alias("gap_last"), "missing")


@query
def slot_gaps_all(spark, sf):
    """Every pack on every platform, at the cadence of the feeds."""
    return LT.pack_gaps(T.listings(spark, sf), T.PLATFORMS)


# --- union and duplicates -----------------------------------------------------------------

@query
def unified(spark, sf):
    return N.unify(list(_normalised(spark, sf).values()))


@query
def dedup(spark, sf):
    return _unified(spark, sf)


@query
def dedup_audit(spark, sf):
    return N.duplicate_audit(N.unify(list(_normalised(spark, sf).values())))


# --- aggregates ---------------------------------------------------------------------------

@query
def price_analytics(spark, sf):
    return _rounded(A.price_analytics(_unified(spark, sf)), "price_stddev", places=2)


@query
def incremental_refresh(spark, sf):
    """The weekdays in a full run, then Saturdays and Sundays, whose rows come late, as batches of their own."""
    store = Store(new_folder(spark, "refreshed"), ("platform",))
    rows, weekday = T.unified_listings(spark, sf), F.weekday("snapshot_time")
    RF.rebuild(rows.filter(weekday < 5), store)
    for batch, day in enumerate((5, 6), 1):
        RF.refresh(rows.filter(weekday == day), store, batch)
    return _rounded(RF.read(spark, store, "price_analytics"), "price_stddev", places=2)


@query
def delivery_analytics(spark, sf):
    return A.delivery_analytics(_unified(spark, sf))


@query
def revenue_analytics(spark, sf):
    return A.revenue_analytics(T.listings(spark, sf))


@query
def stock_analytics(spark, sf):
    return A.stock_analytics(T.listings(spark, sf))


@query
def daily_demand(spark, sf):
    return A.daily_demand(T.listings(spark, sf))


@query
def hourly_price(spark, sf):
    return A.hourly_price(P.states(P.PRICES, T.listings(spark, sf)))


@query
def category_revenue(spark, sf):
    return A.category_revenue(T.listings(spark, sf))


@query
def category_demand_trend(spark, sf):
    return A.category_demand_trend(T.listings(spark, sf))


@query
def surge_heatmap(spark, sf):
    return A.surge_heatmap(T.listings(spark, sf))


@query
def seasonal_index(spark, sf):
    return A.seasonal_index(T.listings(spark, sf))


@query
def delivery_contrast(spark, sf):
    return A.delivery_contrast(T.enriched(spark, sf))


@query
def availability_rates(spark, sf):
    return A.availability_rates(T.listings(spark, sf))


@query
def platform_scorecard(spark, sf):
    return A.platform_scorecard(T.listings(spark, sf))


@query
def weekly_price_index(spark, sf):
    return A.weekly_price_index(T.listings(spark, sf))


@query
def discount_frequency(spark, sf):
    return A.discount_frequency(T.listings(spark, sf))


@query
def top10_revenue(spark, sf):
    return A.top_revenue_products(T.listings(spark, sf))


# --- windows ------------------------------------------------------------------------------

@query
def rolling_demand(spark, sf):
    return TR.rolling_demand(T.listings(spark, sf))


@query
def rolling_demand_calendar(spark, sf):
    return TR.rolling_demand_calendar(T.listings(spark, sf))


@query
def trend_labels(spark, sf):
    return TR.trend_labels(T.listings(spark, sf))


@query
def label_distribution(spark, sf):
    return TR.label_distribution(TR.trend_labels(T.listings(spark, sf)))


@query
def price_volatility_7d(spark, sf):
    return _rounded(TR.price_volatility(T.listings(spark, sf)), "volatility")


@query
def availability_24h(spark, sf):
    return TR.availability_24h(T.listings(spark, sf))


@query
def availability_7d(spark, sf):
    return TR.availability_7d(T.listings(spark, sf))


@query
def price_history_7d(spark, sf):
    return TR.price_history(T.listings(spark, sf))


@query
def top10_trending(spark, sf):
    return TR.top_trending_by_category(TR.trend_labels(T.listings(spark, sf)))


@query
def top5_trending(spark, sf):
    return TR.top_trending(TR.trend_labels(T.listings(spark, sf)))


# --- current state and joins --------------------------------------------------------------

@query
def latest_snapshot(spark, sf):
    return LT.latest_snapshot(T.listings(spark, sf))


@query
def fastest_now(spark, sf):
    return LT.fastest_now(LT.latest_snapshot(T.listings(spark, sf)))


@query
def side_by_side(spark, sf):
    return LT.side_by_side(LT.latest_snapshot(T.listings(spark, sf)), ("alpha", "beta"))


@query
def cheapest(spark, sf):
    return LT.cheapest(LT.latest_snapshot(T.listings(spark, sf)))


@query
def single_platform_products(spark, sf):
    return LT.single_platform_products(T.listings(spark, sf))


@query
def asof_price(spark, sf):
    rows = T.listings(spark, sf).select("record_id", "product_name", "platform", "snapshot_time", "effective_price")
    left = rows.filter("platform = 'gamma'").drop("platform")
    right = rows.filter("platform = 'alpha'").select(
        "product_name", "snapshot_time", F.col("effective_price").alias("price"), F.col("record_id").alias("id"))
    return LT.as_of_join(left, right, ["product_name"], "snapshot_time", "snapshot_time", ["price", "id"])


@query
def asof_price_all(spark, sf):
    """Every row of every platform against the earlier prices of each platform, its own included."""
    rows = T.listings(spark, sf).select("record_id", "product_name", "platform", "snapshot_time", "effective_price")
    return LT.as_of_join_each(rows, ["product_name"], "platform", T.PLATFORMS, "snapshot_time",
                              {"price": "effective_price", "id": "record_id"})


# --- scoring ------------------------------------------------------------------------------

def _scorable(spark, sf):
    rows = T.listings(spark, sf)
    return S.with_defaults(LT.latest_snapshot(rows), TR.availability_7d(rows))


@query
def weight_profiles(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    key = F.col("c_custkey")
    zero = key % 50 == 0
    sliders = customers.select(key.alias("user_id"), *[
        F.when(zero, 0).otherwise(key * k % 101).alias(n) for n, k in (("price", 1), ("delivery", 7), ("quality", 13))])
    return S.normalise_weights(sliders, "price", "delivery", "quality")


@query
def score_platforms(spark, sf):
    return S.score_platforms(_scorable(spark, sf)).drop("rank")


@query
def rank_platforms(spark, sf):
    return S.score_platforms(_scorable(spark, sf), rank_last_if_unavailable=True).select(
        "product_name", "pack_size", "pack_unit", "platform", "in_stock", "composite_score", "rank")


@query
def recommendation(spark, sf):
    return S.recommend(S.score_platforms(_scorable(spark, sf))).drop("platforms", "user_weights")


@query
def comparison_record(spark, sf):
    """The nested record, written as JSON and read back, one row per array entry."""
    path = new_folder(spark, "comparison")
    records = S.recommend(S.score_platforms(_scorable(spark, sf)))
    records.write.json(path)
    back = spark.read.schema(records.schema).json(path)
    entry = F.inline("platforms")
    return back.select("product_name", "pack_size", "pack_unit", "comparison_time", "recommended_platform",
                       F.col("user_weights.price").alias("w_price"), F.col("user_weights.delivery").alias("w_delivery"),
                       F.col("user_weights.quality").alias("w_quality"), entry)


@query
def response_text(spark, sf):
    records = S.recommend(S.score_platforms(_scorable(spark, sf)))
    out = S.answer_text(records, D.platform_names(spark, T.DISPLAY_NAMES), T.LOCATION)
    return out.select("product_name", "pack_size", "pack_unit", F.col("sentence").alias("answer"))


@query
def weight_sensitivity(spark, sf):
    return S.weight_sensitivity(_scorable(spark, sf), PROFILES)


@query
def slider_ranges(spark, sf):
    return EV.winner_ranges(_scorable(spark, sf))


@query
def stockout_risk(spark, sf):
    rows = T.listings(spark, sf)
    return S.stockout_risk(rows, LT.latest_snapshot(rows), TR.latest_time(rows))


# --- questions ----------------------------------------------------------------------------

@query
def intent_label(spark, sf):
    return T.questions(spark, sf).select("question_id", X.intent_label("text", T.PLATFORM_ALIASES).alias("intent"))


@query
def product_mention(spark, sf):
    return X.product_mention(T.questions(spark, sf), T.catalogue(spark, sf)).select("question_id", "product")


@query
def pack_mention(spark, sf):
    return T.questions(spark, sf).select("question_id", X.pack_mention("text").alias("pack"))


@query
def platform_mention(spark, sf):
    return T.questions(spark, sf).select("question_id", F.array_join(
        X.platform_mention("text", T.PLATFORM_ALIASES), ",").alias("platforms_named"))


def _parsed(spark, sf):
    return X.parse_questions(T.questions(spark, sf), T.catalogue(spark, sf), T.PLATFORM_ALIASES)


@query
def parsed_queries(spark, sf):
    return _parsed(spark, sf).withColumn("platforms_named", F.array_join("platforms_named", ","))


@query
def intent_counts(spark, sf):
    parsed = _parsed(spark, sf).withColumn("origin", F.substring("question_id", 1, 1))
    return X.intent_counts(parsed, "origin")


@query
def answer_queries(spark, sf):
    rows = T.listings(spark, sf)
    latest = Z.stored(LT.latest_snapshot(rows), "latest")
    scorable = S.with_defaults(latest, TR.availability_7d(rows))
    records = Z.stored(S.recommend(S.score_platforms(scorable)), "records")
    top = TR.top_trending(TR.trend_labels(rows))
    out = X.answer_questions(_parsed(spark, sf), records, latest, top)
    return out.withColumn("platforms_named", F.array_join("platforms_named", ","))


# --- usage --------------------------------------------------------------------------------

@query
def mau(spark, sf):
    return U.monthly_active_users(T.read_events(spark, sf))


@query
def sessions(spark, sf):
    return U.sessions(T.read_events(spark, sf)).drop("by_type")


@query
def session_summary(spark, sf):
    return U.session_summary(U.sessions(T.read_events(spark, sf)))


@query
def session_share(spark, sf):
    return U.session_share(U.sessions(T.read_events(spark, sf)))


@query
def events_per_session(spark, sf):
    return U.events_per_session(U.sessions(T.read_events(spark, sf)))


@query
def return_rate_7d(spark, sf):
    return U.return_rate(T.read_events(spark, sf))


@query
def p95_value(spark, sf):
    return _rounded(U.value_percentile(T.read_events(spark, sf)), "p_value")


@query
def late_rows(spark, sf):
    lag = F.make_dt_interval(mins=((F.col("event_id") * 37) % 91).cast("int"))
    events = T.read_events(spark, sf).withColumn("arrived", F.col("ts") + lag)
    marks = Z.stored(U.batch_watermarks(events, "arrived"), "watermarks")
    return U.late_rows(events, "arrived", marks).select("event_id", "ts", "arrived", "batch", "watermark")


# --- streaming ----------------------------------------------------------------------------

def _event_stream(spark, sf):
    return ST.stream_of(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _listing_stream(spark, sf):
    return T.listings(spark, sf, ST.stream_of(spark, f"{sf}/lineitem.parquet"))


def _windows(stream, table, label):
    """All windows of the stream, the open ones too, from the stored states of its batches."""
    path = new_folder(stream.sparkSession, f"stream-{label}")
    LG.run(stream, table, path)
    return LG.results(stream.sparkSession, table, path)


@query
def stream_tumbling(spark, sf):
    return _windows(_event_stream(spark, sf), LG.tumbling_counts(), "tumbling")


@query
def stream_hourly_price(spark, sf):
    return _windows(_listing_stream(spark, sf), LG.hourly_price(), "hourly")


@query
def stream_sliding(spark, sf):
    return _windows(_listing_stream(spark, sf), LG.sliding_availability(), "sliding")


@query
def stream_sliding_product(spark, sf):
    return _windows(_listing_stream(spark, sf), LG.sliding_availability(by_product=True), "sliding-product")


@query
def stream_late_rows(spark, sf):
    """Events that arrive up to 90 hours late, files and a call per week of arrival: the stream goes on where the
    call before ended, and the rows of windows that were closed by then are found in the sink of late rows."""
    lag = F.make_dt_interval(hours=((F.col("event_id") * 37) % 91).cast("int"))
    events = T.read_events(spark, sf).withColumn("part", F.floor(F.unix_date(F.to_date(F.col("ts") + lag)) / 7))
    inbox, path = new_folder(spark, "arrivals"), new_folder(spark, "stream-late")
    table = LG.tumbling_counts()
    for part in sorted(r.part for r in events.select("part").distinct().collect()):
        events.filter(F.col("part") == part).write.mode("append").parquet(inbox)
        LG.run(spark.readStream.schema(events.schema).parquet(inbox), table, path)
    late = LG.late_rows(spark, path)
    if late is None:
        late = events.limit(0).withColumn("batch", F.lit(0).cast("long"))
    return late.select("event_id", "ts", "event_type", "part", "batch")


@query
def stream_dedup(spark, sf):
    copies = F.when(F.col("event_id") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = _event_stream(spark, sf).withColumn("copy", F.explode(copies)).drop("copy")
    return ST.replay(ST.deduplicated(events), "dedup").select("event_id", "ts", "user_id", "event_type", "value")


@query
def stream_sessions(spark, sf):
    return _windows(_event_stream(spark, sf), LG.session_windows(), "sessions")


# The names that the queries over all windows had before.
for _name in ("stream_tumbling", "stream_hourly_price", "stream_sliding", "stream_sessions"):
    QUERIES[f"{_name}_all"] = QUERIES[_name]


# --- forecasts and models -----------------------------------------------------------------

def _series(spark, sf):
    return FC.demand_series(T.listings(spark, sf))


@query
def horizon_features(spark, sf):
    return FC.horizon_features(_series(spark, sf))


@query
def naive_forecast(spark, sf):
    return FC.naive_forecast(_series(spark, sf))


@query
def forecast_overlay(spark, sf):
    return FC.forecast_overlay(_series(spark, sf))


@query
def forecast_interval(spark, sf):
    return _rounded(FC.forecast_interval(_series(spark, sf)), "confidence_lower", "confidence_upper")


@query
def forecast_record(spark, sf):
    rows = T.listings(spark, sf)
    end = TR.latest_time(rows)
    risk = S.stockout_risk(rows, LT.latest_snapshot(rows), end)
    trends = TR.latest_trends(TR.trend_labels(rows))
    out = FC.forecast_records(trends, FC.baseline_errors(TR.rolling_demand(rows)), risk, end)
    return _rounded(out, "confidence_lower", "confidence_upper")


@query
def forecast_mape(spark, sf):
    rows = FC.naive_forecast(_series(spark, sf)).filter("naive_24h is not null")
    return _rounded(FC.forecast_errors(rows, "demand", "naive_24h"), "mape", "rmse", "mae")


def _baseline_labels(spark, sf):
    labels = FC.previous_label(TR.trend_labels(T.listings(spark, sf)))
    return FC.time_split(labels)[1]


@query
def trend_confusion(spark, sf):
    return FC.confusion(_baseline_labels(spark, sf))


@query
def trend_scores(spark, sf):
    return _rounded(FC.classification_scores(FC.confusion(_baseline_labels(spark, sf))), "accuracy", "weighted_f1")


@query
def indexed_features(spark, sf):
    from pyspark.ml.functions import vector_to_array
    rows = M.index_features(M.ml_features(T.unified_listings(spark, sf)))
    return rows.select("record_id", *M.INDEXED.values(), F.size(vector_to_array("features")).alias("n_features"))


@query
def category_means(spark, sf):
    """What the regressor sees of a category value: the mean target of the other folds' training rows."""
    train = FC.time_split(M.ml_features(T.unified_listings(spark, sf)))[0]
    target = F.col("units_ordered")
    cells = Z.stored(M.category_cells(train, M.INDEXED, M.fold_of(M.FOLD_KEYS["demand"]), [target]), "category-cells")
    overall = train.agg(F.avg(target)).first()[0] or 0.0
    return _rounded(M.means_of_other_folds(cells, [overall]).withColumnRenamed("mean_0", "mean_of_others"), "mean_of_others", places=6)


@query
def conformal_interval(spark, sf):
    """Yesterday's demand as the forecast, bounds from its errors in the test month."""
    ahead = FC.naive_forecast(_series(spark, sf)).filter("naive_24h IS NOT NULL").withColumn("month", F.month("date"))
    ahead = Z.stored(ahead.withColumn("predicted", F.col("naive_24h").cast("double")), "naive")
    held = ahead.filter(F.col("month") == fv.TEST_MONTH).withColumn("error", F.col("demand") - F.col("predicted"))
    levels = {"series": FC.GRAIN, "platform": ("platform",), "all": ()}
    return CF.with_bounds(ahead, Z.stored(CF.error_bounds(held, levels), "bounds"), levels).select(
        *FC.GRAIN, "date", "demand", "predicted", "confidence_lower", "confidence_upper", "interval_level")


@query
def demand_alert(spark, sf):
    """Stock against the mean demand of the last seven rows."""
    rows = T.listings(spark, sf)
    trends = TR.latest_trends(TR.trend_labels(rows)).withColumn("predicted_demand_index", F.col("rolling_avg_7d"))
    return _rounded(S.demand_alerts(LT.latest_snapshot(rows), trends), "predicted_demand_index", "predicted_hours_of_cover")


@query
def forecast_record_model(spark, sf):
    """Forecast records of the horizon models, with intervals from the test month."""
    store = Store(new_folder(spark, "trained"))
    rows = M.ml_features(T.unified_listings(spark, sf))
    J.train_horizons(store, rows)
    end, newest = TR.latest_time(rows), LT.latest_snapshot(rows)
    return FC.model_records(spark.read.parquet(store.curated("horizon_predictions")), TR.latest_trends(TR.trend_labels(rows)),
                            S.stockout_risk(rows, newest, end), end, T.LOCATION, fv.DEMAND_MODEL_VERSION, J.HORIZON_GRAIN)


@query
def demand_forecast(spark, sf):
    rows = M.ml_features(T.unified_listings(spark, sf))
    model = M.save_and_reload(M.fit_demand_model(FC.time_split(rows)[0]), new_folder(spark, "demand-model"))
    return M.forecast_demand(model, rows, T.LOCATION)


@query
def trend_classify(spark, sf):
    labels = TR.trend_labels(T.listings(spark, sf))
    model = M.save_and_reload(M.fit_trend_model(FC.time_split(labels)[0]), new_folder(spark, "trend-model"))
    return M.classify_trends(model, labels, T.LOCATION)


@query
def horizon_forecast(spark, sf):
    table = Z.stored(FC.horizon_table(_series(spark, sf)), "horizons")
    return M.forecast_horizons(table).select(
        "category", "platform", "date", "demand", "predicted_24h", "predicted_72h", "demand_in_24h", "demand_in_72h")
