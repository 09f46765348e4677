"""Null keys in joins, conformal bounds, and the forecast records of the training job."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.functions.joins import null_safe_join
from shelfline.operators import conformal as CF
from shelfline.operators import forecast as FC
from shelfline.operators import latest as LT
from shelfline.operators import models as M
from shelfline.operators import score as S
from shelfline.operators import trend as TR
from shelfline.plans import jobs
from shelfline.plans import refresh as RF

START = datetime(2024, 4, 1, 9)
LEVELS = {"series": ("category", "platform"), "platform": ("platform",), "all": ()}


def series(*groups, days=40):
    return [(c, p, date(2024, 4, 1) + timedelta(days=d), 3 + (d * 7 + len(p)) % 5) for c, p in groups for d in range(days)]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, 2, "y"), (3, 3, "z")], "k int, l int, a string")
    b = spark.createDataFrame([(1, None, "X"), (None, 2, "Y"), (4, 4, "W")], "k int, l int, b string")
    got = {tuple(r) for r in null_safe_join(a, b, ("k", "l"), "full").collect()}
    assert got == {(1, None, "x", "X"), (None, 2, "y", "Y"), (3, 3, "z", None), (4, 4, None, "W")}
    assert null_safe_join(a, b, ("k", "l")).columns == ["k", "l", "a", "b"] and null_safe_join(a, b, ("k", "l"), "left_anti").count() == 1


def test_null_groups_keep_their_intervals(spark):
    rows = spark.createDataFrame(series(("Dairy", "alpha"), (None, "alpha")), "category string, platform string, date date, demand long")
    out = FC.forecast_interval(rows)
    assert out.count() == 78 and out.filter("category IS NULL").count() == 39
    assert FC.forecast_overlay(rows).filter("actual IS NOT NULL AND predicted IS NOT NULL").count() == 78


def test_null_keys_in_records_and_defaults(spark, listing):
    df = listing(*[dict(snapshot_time=START + timedelta(days=d), product_name=p, category=None, units_ordered=2 + d // 7, stock_remaining=0)
                   for d in range(21) for p in ("Milk", None)])
    end = F.lit(START + timedelta(days=20))
    risk = S.stockout_risk(df, LT.latest_snapshot(df), end)
    rows = FC.forecast_records(TR.latest_trends(TR.trend_labels(df)), FC.baseline_errors(TR.rolling_demand(df)), risk, end).collect()
    assert len(rows) == 2 and all(r.stockout_risk == "high" and r.confidence_lower is not None for r in rows)
    kept = S.with_defaults(LT.latest_snapshot(df), TR.availability_7d(df.withColumn("in_stock", F.lit(False)))).collect()
    assert [r.availability_rate_7d for r in kept] == [0.0, 0.0]


def test_bounds_are_order_statistics(spark):
    rng = random.Random(2)
    data = [("big", "alpha", rng.gauss(0, 5)) for _ in range(99)] + [("small", "alpha", 100.0 + i) for i in range(18)]
    data += [(None, "beta", float(i)) for i in range(19)] + [("few", None, -7.0), ("big", "alpha", None)]
    errors = spark.createDataFrame(data, "category string, platform string, error double")
    found = {(r.level, r.category, r.platform): (r.low, r.high, r.n) for r in CF.error_bounds(errors, LEVELS).collect()}

    def want(values):
        values, n = sorted(values), len(values)
        return values[int((n + 1) * .05 + 1e-9) - 1], values[-(-(n + 1) * 95 // 100) - 1], n

    assert found == {("series", "big", "alpha"): want([e for c, _, e in data if c == "big" and e is not None]),
                     ("series", None, "beta"): (0.0, 18.0, 19),
                     ("platform", None, "alpha"): want([e for _, p, e in data if p == "alpha" and e is not None]),
                     ("platform", None, "beta"): (0.0, 18.0, 19), ("all", None, None): want([e for *_, e in data if e is not None])}
    assert CF.least_rows() == 19 and CF.least_rows(0.5) == 3

    rows = spark.createDataFrame([("big", "alpha", 50.0), ("small", "alpha", 50.0), (None, "beta", 50.0), ("few", None, 50.0), ("big", "beta", 1.0)],
                                 "category string, platform string, predicted double")
    got = {(r.category, r.platform): r for r in CF.with_bounds(rows, CF.error_bounds(errors, LEVELS), LEVELS).collect()}
    assert {k: r.interval_level for k, r in got.items()} == {
        ("big", "alpha"): "series", ("small", "alpha"): "platform", (None, "beta"): "series", ("few", None): "all", ("big", "beta"): "platform"}
    assert got[None, "beta"].confidence_lower == 50.0 and got[None, "beta"].confidence_upper == 68.0
    none = CF.with_bounds(rows, CF.error_bounds(errors.limit(0), LEVELS), LEVELS).first()
    assert none.confidence_lower is None and none.confidence_upper is None and none.interval_level is None


def test_coverage_of_later_days(spark):
    """Bounds of one month hold for nine in ten days of another, whatever the error's shape and the group's spread."""
    errors = [(i, (i % 20 + 1) * random.Random(i).expovariate(1.0)) for i in range(6000)]
    rows = spark.createDataFrame([(f"c{i % 20}", "alpha" if i % 2 else "beta", e, i >= 3000, 1000.0, 1000.0 + e) for i, e in errors],
                                 "category string, platform string, error double, later boolean, predicted double, demand double")
    bounds = CF.error_bounds(rows.filter("NOT later"), LEVELS)
    done = CF.with_bounds(rows.filter("later"), bounds, LEVELS)
    whole = CF.coverage(done, "demand").first()
    assert whole.n == 3000 and 0.88 <= whole.coverage <= 0.93
    assert all(r.coverage > 0.8 for r in CF.coverage(done, "demand", ("category",)).collect())


def test_demand_alerts(spark, listing):
    stock = {"Milk": 5, "Bread": 100, "Eggs": 0, "Salt": 4, None: 1}
    latest = listing(*[dict(product_name=p, stock_remaining=n) for p, n in stock.items()])
    predicted = spark.createDataFrame([("Milk", "alpha", 11.0), ("Bread", "alpha", 11.0), ("Eggs", "alpha", 0.0), (None, "alpha", 9.0)],
                                      "product_name string, platform string, predicted_demand_index double")
    got = {r.product_name: (r.demand_alert, r.predicted_hours_of_cover) for r in S.demand_alerts(latest, predicted).collect()}
    assert got == {"Milk": (True, 120 / 11), "Bread": (False, 2400 / 11), "Eggs": (True, None), "Salt": (False, None), None: (True, 24 / 9)}


def test_training_writes_records(spark, listing, tmp_path):
    days = [START + timedelta(days=d) for d in range(140)]
    df = listing(*[dict(record_id=f"{p}{c}{d}", snapshot_time=t, month=t.month, product_name=c, category=c, platform=p,
                        units_ordered=5 + t.weekday() + random.Random(f"{p}{c}{d}").randrange(3))
                   for d, t in enumerate(days) for p in ("alpha", "beta") for c in ("Milk", None)])
    store = jobs.Store(str(tmp_path / "store"), ("platform",))
    RF.rebuild(df, store)
    out = jobs.train(spark, store, "Old Town", demand={"maxIter": 1}, trends={"numTrees": 2}, horizons={"maxIter": 5})
    assert set(out["horizons"]) == {"24h", "72h"}
    for h, scores in out["horizons"].items():
        assert 0 < scores["mape"] < 40 and 0.75 <= scores["coverage"] <= 1.0  # July and August, neither fitted nor calibrated on
        assert M.PipelineModel.load(store.model(f"demand_{h}")).stages
    records = spark.read.parquet(store.curated("forecast_records")).collect()
    assert sorted((str(r.product_name), r.platform, r.forecast_horizon_hours) for r in records) == sorted(
        (c, p, h) for c in ("Milk", "None") for p in ("alpha", "beta") for h in (24, 72))
    for r in records:
        assert r.confidence_lower <= r.predicted_demand_index <= r.confidence_upper and r.interval_level == "series"
        assert r.trend_label in ("trending", "stable", "declining") and r.stockout_risk in ("high", "medium", "low")
        assert r.location == "Old Town" and r.forecast_generated_at == days[-1] and r.date == days[-1].date()
    assert {r[0] for r in spark.read.parquet(store.curated("demand_alerts")).select("product_name").collect()} == {"Milk", None}
    assert spark.read.parquet(store.curated("trending")).columns[:2] == ["category", "rank"]


def test_bounds_over_all_rows_are_a_value_not_a_join(spark):
    rows = spark.createDataFrame([("A", "alpha", 5.0), (None, "beta", 1.0)], "category string, platform string, predicted double")
    bounds = spark.createDataFrame([("all", None, None, -2.0, 3.0, 20)], "level string, category string, platform string, low double, high double, n long")
    out = CF.with_bounds(rows, bounds, LEVELS)
    assert {tuple(r)[2:] for r in out.collect()} == {(5.0, 3.0, 8.0, "all"), (1.0, 0.0, 4.0, "all")}
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    none = CF.with_bounds(rows, bounds.filter("false"), LEVELS)
    assert {tuple(r)[2:] for r in none.collect()} == {(5.0, None, None, None), (1.0, None, None, None)}
