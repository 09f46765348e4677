import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfline.operators import aggregate as A
from shelfline.operators import partials as P
from shelfline.operators import forecast as FC
from shelfline.operators import latest as LT
from shelfline.operators import trend as TR

START = datetime(2024, 4, 1, 9)


def days(listing, units, skip=()):
    return listing(*[dict(snapshot_time=START + timedelta(days=i), units_ordered=u)
                     for i, u in enumerate(units) if i not in skip])


def test_previous_frame_is_null_for_seven_rows_only(spark, listing):
    rows = TR.rolling_demand(days(listing, range(1, 16))).orderBy("date").collect()
    assert [r.rolling_avg_prev_7d is None for r in rows] == [True] * 7 + [False] * 8
    assert rows[7].rolling_avg_prev_7d == 1.0 and rows[7].rolling_avg_7d == sum(range(2, 9)) / 7
    assert TR.trend_labels(days(listing, range(1, 16))).count() == 8


def test_labels(spark, listing):
    up = TR.trend_labels(days(listing, [1] * 7 + [2] * 7)).orderBy("date").collect()[-1]
    down = TR.trend_labels(days(listing, [2] * 7 + [1] * 7)).orderBy("date").collect()[-1]
    same = TR.trend_labels(days(listing, [2] * 14)).orderBy("date").collect()[-1]
    assert (up.trend_label, down.trend_label, same.trend_label) == ("trending", "declining", "stable")
    first = TR.label_trend(TR.rolling_demand(days(listing, [1, 9]))).collect()
    assert {r.trend_label for r in first} == {"stable"}


def test_row_and_calendar_windows_differ_on_gaps(spark, listing):
    df = days(listing, range(1, 11), skip=(3, 4, 5))
    rows = {r.date.day: r.rolling_avg_7d for r in TR.rolling_demand(df).collect()}
    cal = {r.date.day: r.rolling_avg_7d for r in TR.rolling_demand_calendar(df).collect()}
    assert rows[10] == (1 + 2 + 3 + 7 + 8 + 9 + 10) / 7 and cal[10] == (7 + 8 + 9 + 10) / 4


def test_revenue_is_the_same_at_every_grain(spark, listing):
    df = listing(*[dict(revenue_inr=i / 100, category="Dairy" if i % 2 else "Snacks", pack_size=i % 3) for i in range(50)])
    fine = A.revenue_analytics(df).agg(F.sum("total_revenue")).first()[0]
    coarse = A.category_revenue(df).agg(F.sum("revenue")).first()[0]
    assert abs(fine - coarse) < 1e-9 and abs(fine - sum(range(50)) / 100) < 1e-9


def test_hourly_price_from_aggregate_equals_rows(spark, listing):
    df = listing(*[dict(effective_price=float(i * 7 % 31) + 0.01, pack_size=i % 4) for i in range(40)])
    got = A.hourly_price(P.states(P.PRICES, df)).first()
    cents = [(i * 7 % 31) * 100 + 1 for i in range(40)]
    assert got.avg_price == sum(cents) / 40 / 100 and got.record_count == 40


def test_hourly_price_of_nulls_and_four_decimals(spark, listing):
    prices = [(9, 10.0), (9, 20.0), (9, None), (9, 100.0), (10, 1.2345), (11, None)]
    df = listing(*[dict(hour_of_day=h, effective_price=p, pack_size=i) for i, (h, p) in enumerate(prices)])
    got = {r.hour: (r.avg_price, r.record_count) for r in A.hourly_price(P.states(P.PRICES, df)).collect()}
    assert got == {9: (13000 / 3 / 100, 4), 10: (1.2345, 1), 11: (None, 1)}


def test_stddev_of_one_row_is_null(spark, listing):
    assert A.price_analytics(listing({})).first().price_stddev is None


def test_latest_snapshot_and_as_of(spark, listing):
    df = listing(*[dict(snapshot_time=START + timedelta(hours=h), effective_price=float(h)) for h in range(5)])
    assert LT.latest_snapshot(df).first().effective_price == 4.0
    assert LT.latest_snapshot(df, F.lit(START + timedelta(hours=2))).first().effective_price == 2.0


def test_single_platform(spark, listing):
    df = listing(dict(product_name="a"), dict(product_name="b"), dict(product_name="b", platform="beta"),
                 dict(product_name="a", platform="beta", snapshot_time=START - timedelta(days=60)))
    assert [r.product_name for r in LT.single_platform_products(df).collect()] == ["a"]


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(7)
    left, right = [], []
    for i in range(300):
        # One key holds most rows; times fall on few instants so that ties and empty slots occur.
        left.append((rng.choice("aaaaab"), START + timedelta(minutes=15 * rng.randrange(400)), i))
        right.append((rng.choice("aaaaac"), START + timedelta(minutes=15 * rng.randrange(400)), rng.randrange(50)))
    l = spark.createDataFrame(left, "k string, t timestamp, id int").repartition(5)
    r = spark.createDataFrame(right, "k string, t timestamp, price int").repartition(3)
    for slot in ("hour", "day"):
        got = {x.id: (x.ref_time, x.ref_price) for x in
               LT.as_of_join(l, r, ["k"], "t", "t", ["price"], slot).collect()}
        assert len(got) == 300
        for k, t, i in left:
            before = [(rt, p) for rk, rt, p in right if rk == k and rt < t]
            assert got[i] == (max(before) if before else (None, None))


def test_as_of_each_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice(["x", "y", None]),
             rng.choice([None] + [START + timedelta(hours=3 * rng.randrange(60))] * 9), i, rng.choice([None, 1, 2])) for i in range(250)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "k string, p string, t timestamp, id int, price int").repartition(5)
    out = LT.as_of_join_each(df, ["k"], "p", ("x", "y"), "t", {"price": "price", "id": "id"})
    assert out.columns == ["k", "ref_p", "p", "t", "id", "price", "ref_time", "ref_price", "ref_id"]

    def low(*values):  # null before everything
        return tuple((v is not None, v if v is not None else 0) for v in values)

    def time(t):
        return t.timestamp() if t else None

    want = []
    for k, p, t, i, price in rows:
        for m in ("x", "y"):
            found = [(time(rt), rp, ri, rt) for rk, p2, rt, ri, rp in rows if rk == k and p2 == m and low(time(rt)) < low(time(t))]
            best = max(found, key=lambda r: low(*r[:3]), default=(None,) * 4)
            want.append((k, m, p, t, i, price, best[3], best[1], best[2]))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def test_as_of_each_shuffles_rows_once_before_it_repeats_them(spark, sf_dir):
    from shelfline.plans.queries import QUERIES
    plan = spark._jvm.PythonSQLUtils.explainString(QUERIES["asof_price_all"](spark, sf_dir)._jdf.queryExecution(), "simple")
    assert 0 <= plan.index("Generate") < plan.index("Window") and "Union" not in plan


def test_gaps_against_brute_force(spark, listing):
    rng = random.Random(3)
    seen = {(p, q, rng.randrange(40)) for p in "xy" for q in ("alpha", "beta") for _ in range(12)} - {("y", "beta", 5)}
    df = listing(*[dict(product_name=p, platform=q, snapshot_time=START + timedelta(minutes=15 * s)) for p, q, s in seen])
    out = LT.series_gaps(df, ["product_name"], ("alpha", "beta", "gamma"), 900).collect()
    base = int(START.timestamp()) // 900
    low, high = min(s for *_, s in seen), max(s for *_, s in seen)
    missing = {(r.product_name, r.platform, s - base) for r in out for s in range(r.gap_first, r.gap_last + 1)}
    grid = {(p, q, s) for p in "xy" for q in ("alpha", "beta", "gamma") for s in range(low, high + 1)}
    assert missing == grid - seen and sum(r.missing for r in out) == len(missing)
    inner = LT.series_gaps(df, ["product_name"], ("alpha", "beta"), 900, first=F.lit(START + timedelta(minutes=150)),
                           last=F.lit(START + timedelta(minutes=300))).collect()
    got = {(r.product_name, r.platform, s - base) for r in inner for s in range(r.gap_first, r.gap_last + 1)}
    assert got == {(p, q, s) for p in "xy" for q in ("alpha", "beta") for s in range(10, 21)} - seen


def test_horizons_use_the_calendar(spark, listing):
    series = FC.demand_series(days(listing, range(1, 9), skip=(4,)))
    rows = {r.date.day: r for r in FC.horizon_features(series).collect()}
    assert rows[1].demand_in_24h == 2 and rows[1].demand_in_72h == 4
    assert rows[4].demand_in_24h is None and rows[2].demand_in_72h is None
    naive = {r.date.day: r for r in FC.naive_forecast(series).collect()}
    assert naive[2].naive_24h == 1 and naive[6].naive_24h is None and naive[4].naive_72h == 1


def test_errors_of_an_empty_set_are_null(spark):
    df = spark.createDataFrame([(0, 1.0)], "a int, p double")
    row = FC.forecast_errors(df, "a", "p").first()
    assert row.mape is None and row.mae == 1.0
    assert FC.forecast_errors(df.filter("a > 0"), "a", "p").first().rmse is None


def test_classification_scores_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rng = random.Random(1)
    pairs = [(float(rng.randrange(3)), float(rng.randrange(4))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    row = FC.classification_scores(FC.confusion(df, "label", "prediction")).first()
    for name, value in (("accuracy", row.accuracy), ("weightedFMeasure", row.weighted_f1)):
        assert abs(MulticlassClassificationEvaluator(metricName=name).evaluate(df) - value) < 1e-12
