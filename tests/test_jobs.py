from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.operators import models as M
from shelfline.operators import trend as TR
from shelfline.plans import jobs
from shelfline.sources import testtables as T
from shelfline.sources import zones as Z


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    feeds = {}
    for name, raw in T.raw_feeds(spark, sf_dir).items():
        path = str(root / f"raw-{name}")
        raw.write.parquet(path)
        feeds[name] = (path, T.FEEDS[name])
    out = jobs.Store(str(root / "out"), partitions=("platform",))
    counts = jobs.preprocess(spark, feeds, out)
    jobs.compare(spark, out)
    return out, feeds, counts


def test_preprocess_counts(spark, store):
    out, feeds, counts = store
    raw = sum(spark.read.parquet(path).count() for path, _ in feeds.values())
    unified = jobs.load_unified(spark, out)
    assert counts["union"]["rows"] == raw and counts["unified"]["rows"] == unified.count() < raw
    assert unified.select("record_id", "platform", "snapshot_time").distinct().count() == unified.count()


def test_aggregates_agree(spark, store):
    out, _, counts = store
    rows = counts["unified"]["rows"]
    for name in set(jobs.AGGREGATES) - {"daily_demand"}:  # which has no row counts
        assert spark.read.parquet(out.processed(name)).agg(F.sum("record_count")).first()[0] == rows


def test_preprocess_reports_gaps_of_every_pack(spark, store):
    out, feeds, _ = store
    gaps = spark.read.parquet(out.processed("slot_gaps"))
    packs = jobs.load_unified(spark, out).select("product_name", "pack_size", "pack_unit", F.explode(F.array(*map(F.lit, feeds))).alias("platform"))
    assert packs.join(gaps, ["product_name", "pack_size", "pack_unit", "platform"], "left_anti").count() == 0


def test_partitions_are_pruned(spark, tmp_path, listing):
    path = str(tmp_path / "zone")
    Z.write_zone(listing({}, dict(platform="beta"), dict(snapshot_time=datetime(2024, 4, 2))), path)
    df = Z.read_zone(spark, path).filter("date = date'2024-04-01' and platform = 'beta'").select("mrp")
    assert df.count() == 1
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<mrp:double>" in plan


def test_recent_reads_only_the_last_folders(spark, tmp_path, listing):
    out = jobs.Store(str(tmp_path / "dated"))
    Z.write_zone(listing(*[dict(snapshot_time=datetime(2024, 4, 1, 9) + timedelta(days=d), in_stock=d % 2 == 0) for d in range(20)]),
                 out.processed("unified"))
    df = jobs.load_recent(spark, out, 7)
    assert df.count() == 8
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "date_sub(Subquery" in plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert jobs.load_recent(spark, out, 3, F.lit(datetime(2024, 4, 10, 12))).agg(F.max("snapshot_time")).first()[0] == datetime(2024, 4, 10, 9)
    jobs.compare(spark, out)
    entry = spark.read.parquet(out.curated("platform_comparison")).first().platforms[0]
    assert spark.read.parquet(out.curated("slider_ranges")).count() == 3
    assert [r.stockout_risk for r in spark.read.parquet(out.curated("stockout_risk")).collect()] == ["low"]
    whole = TR.availability_7d(jobs.load_unified(spark, out)).first().availability_rate_7d
    assert entry.availability_rate_7d == whole == 3 / 7


def test_overwrite_replaces_only_written_partitions(spark, tmp_path, listing):
    path = str(tmp_path / "zone")
    one = dict(snapshot_time=datetime(2024, 4, 1, 9))
    Z.write_zone(listing(one, one, dict(snapshot_time=datetime(2024, 4, 2, 9))), path)
    Z.write_zone(listing(one), path)
    assert sorted((str(r.date), r["count"]) for r in Z.read_zone(spark, path).groupBy("date").count().collect()) == [
        ("2024-04-01", 1), ("2024-04-02", 1)]


def test_rebuild_drops_partitions_and_names_keep_their_type(spark, tmp_path, listing):
    path = str(tmp_path / "zone")
    Z.write_zone(listing({}, dict(platform="007")), path)
    assert {r.platform for r in Z.read_zone(spark, path).select("platform").collect()} == {"alpha", "007"}
    Z.write_zone(listing(dict(platform="007")), path, rebuild=True)
    assert [r.platform for r in Z.read_zone(spark, path).select("platform").collect()] == ["007"]


def test_retention_and_sample(spark, tmp_path, listing):
    df = listing(*[dict(snapshot_time=datetime(2024, 12, 31, 9) - timedelta(days=d)) for d in range(0, 400, 10)])
    assert [Z.retain(df, d).count() for d in (30, 180, 365)] == [4, 19, 37]
    assert Z.retention_zones(df).filter("in_raw").count() == 4
    sample = [r.record_id for r in Z.sample_rows(df, 7).collect()]
    assert sample == [r.record_id for r in Z.sample_rows(df.repartition(5), 7).collect()] and len(set(sample)) == 7
    Z.write_sample(df.select("record_id"), str(tmp_path / "csv"), 5)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 5


def test_compaction_keeps_rows(spark, tmp_path, listing):
    df = listing(*[dict(snapshot_time=datetime(2024, 4, 1) + timedelta(minutes=15 * i)) for i in range(100)])
    parts, merged = str(tmp_path / "parts"), str(tmp_path / "merged")
    df.repartition(25).write.parquet(parts)
    Z.compact(spark, parts, merged)
    assert spark.read.parquet(merged).exceptAll(spark.read.parquet(parts)).count() == 0
    assert spark.read.parquet(merged).count() == 100
    assert spark.range(1).select(Z.file_count(spark, merged) < Z.file_count(spark, parts)).first()[0]


def test_answers(spark, store):
    out, _, _ = store
    record = spark.read.parquet(out.curated("platform_comparison")).filter("size(platforms) > 1").orderBy(
        "product_name", "pack_size", "pack_unit").first()
    name, size = record.product_name, record.pack_size
    texts = [("1", f"Where can we get {name} {size} {record.pack_unit}"), ("2", f"cheapest {name} {size} {record.pack_unit}"), ("3", "is it fast"),
             ("4", "no such thing"), ("5", f"side by side {name} {size}{record.pack_unit} at {record.platforms[0].platform}")]
    asked = spark.createDataFrame(texts, "question_id string, text string")
    catalogue = jobs.load_unified(spark, out).select("product_name").distinct()
    rows = {r.question_id: r for r in jobs.answer(spark, out, asked, catalogue, T.PLATFORM_ALIASES, T.DISPLAY_NAMES,
                                                  T.LOCATION).collect()}
    assert len(rows) == 5
    if not name.startswith("hot"):
        assert rows["1"].answer == record.recommended_platform
        assert rows["1"].sentence.startswith(f"For {name} {size}{record.pack_unit} in Old Town, ")
    assert rows["2"].answer == record.best_price_platform
    assert rows["3"].intent == "check_delivery" and rows["3"].answer in T.PLATFORMS
    assert rows["4"].answer is None and rows["4"].sentence.startswith("Sorry")


def test_models_fit_save_and_score(spark, store):
    out, _, _ = store
    scores = jobs.train(spark, out, T.LOCATION, demand={"maxIter": 2}, trends={"numTrees": 3}, horizons={"maxIter": 2})
    assert scores["demand"]["mape"] > 0 and 0 <= scores["trend"]["accuracy"] <= 1
    forecasts = spark.read.parquet(out.curated("demand_forecasts"))
    rows = M.ml_features(jobs.load_unified(spark, out))
    assert forecasts.filter("is_train").count() == rows.filter("month in (4, 5)").count()
    trends = spark.read.parquet(out.curated("trend_labels"))
    assert {r[0] for r in trends.select("predicted_label").distinct().collect()} <= {"trending", "declining", "stable"}
    assert trends.count() == TR.trend_labels(rows).count()


def test_month_filter_reaches_the_scan(spark, store):
    out, _, _ = store
    df = M.ml_features(jobs.load_unified(spark, out)).filter("month = 6").select("units_ordered")
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(month,6)" in plan and "IsNotNull(units_ordered)" in plan


def test_more_categories_than_default_bins(spark, listing):
    df = M.ml_features(listing(*[dict(product_name=f"p{i % 70}", units_ordered=i % 5) for i in range(300)]))
    model = M.fit_demand_model(df, maxIter=1, maxDepth=2)
    assert model.transform(df).count() == 300
    unseen = M.ml_features(listing(dict(product_name="new", platform="new")))
    assert model.transform(unseen).count() == 1


def test_models_of_ten_thousand_products(spark, listing, tmp_path):
    """Demand hangs on the product alone, trends on the category alone."""
    df = M.ml_features(listing(*[dict(product_name=f"p{i % 10_000}", units_ordered=9 if i % 2 else 1) for i in range(20_000)]))
    model = M.fit_demand_model(df, maxIter=3, maxDepth=2, stepSize=1.0)
    back = M.save_and_reload(model, str(tmp_path / "demand"))
    for m in (model, back):
        out = m.transform(df)
        assert out.count() == 20_000 and out.agg(F.max(F.abs(F.col("prediction") - F.col("units_ordered")))).first()[0] < 0.5
    unseen = back.transform(M.ml_features(listing(dict(product_name="new"), dict(product_name=None))))
    assert unseen.count() == 2
    labels = spark.range(20_000).selectExpr(  # rows of trends have a product and a day; their folds hang on these
        "'alpha' AS platform", "'p' AS product_name", "date_add(date'2024-04-01', cast(id AS int)) AS date", "concat('c', id % 10000) AS category", "4 AS month", "1.0D AS daily_demand", "1.0D AS daily_avg_price",
        "1.0D AS rolling_avg_7d", "CASE id % 2 WHEN 0 THEN 'stable' ELSE 'trending' END AS trend_label")
    trends = M.save_and_reload(M.fit_trend_model(labels, numTrees=5, maxDepth=3), str(tmp_path / "trend"))
    assert trends.transform(labels).filter("predicted_label = trend_label").count() == 20_000


def test_bins_do_not_follow_the_catalogue(spark, listing):
    for products in (2, 300):
        df = M.ml_features(listing(*[dict(product_name=f"p{i % products}", units_ordered=i % 5) for i in range(600)]))
        assert M.fit_demand_model(df, maxIter=1, maxDepth=1).stages[-1].getOrDefault("maxBins") == M.MAX_BINS
    assert M.fit_demand_model(df, maxIter=1, maxDepth=1, maxBins=40).stages[-1].getOrDefault("maxBins") == 40


def test_no_row_sees_its_own_target(spark):
    """Unique categories and a random target: nothing to learn, so the means of the other folds must not tell the target."""
    rows = spark.range(2000).selectExpr("concat('r', id) AS record_id", "concat('c', id) AS own", "concat('g', id % 4) AS four",
                                        "pmod(xxhash64(id), 1000) / 10.0 AS y")
    encoder, train = M.mean_encoder(rows, {"own": "own_mean", "four": "four_mean"}, [F.col("y")], ("record_id",))
    assert train.count() == 2000 and train.columns == [*rows.columns, "own_mean", "four_mean"]
    # Without others of its value every row has the overall mean; with the means of all rows the correlation is 1.
    assert train.agg(F.max("own_mean") - F.min("own_mean")).first()[0] < 1e-9
    assert abs(train.agg(F.corr("four_mean", "y")).first()[0]) < 0.1
    scored = encoder.transform(rows)  # outside training a value has the mean of all its rows
    assert scored.agg(F.corr("own_mean", "y")).first()[0] > 0.999


def test_means_of_other_folds(spark):
    data = [(f"r{i}", f"c{i % 3}" if i % 7 else None, float(i % 11), i % 2) for i in range(100)]
    rows = spark.createDataFrame(data, "record_id string, c string, y double, z int")
    encoder, train = M.mean_encoder(rows, {"c": "m"}, [F.col("y"), F.col("z")], ("record_id",))
    folds = dict(rows.select("record_id", M.fold_of(["record_id"])).collect())
    assert set(folds.values()) == set(range(M.FOLDS))
    overall = [sum(r[k] for r in data) / 100 for k in (2, 3)]
    got = {r.record_id: (r.m_0, r.m_1) for r in train.collect()}
    for i, c, _, _ in data:
        others = [r for r in data if r[1] == c and folds[r[0]] != folds[i]]
        want = [(sum(r[k] for r in others) + M.PRIOR_ROWS * o) / (len(others) + M.PRIOR_ROWS) for k, o in zip((2, 3), overall)]
        assert got[i] == pytest.approx(want)
