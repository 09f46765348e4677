import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import score as S
from shelfline.sources import dimensions as D

FIELDS = ("product_name string, pack_size int, pack_unit string, platform string, snapshot_time timestamp, "
          "effective_price double, price_per_unit double, delivery_minutes int, rating double, "
          "availability_rate_7d double, in_stock boolean")


def rows(spark, *entries, pack=500):
    return spark.createDataFrame([("Milk", pack, "ml", p, None, price, price / 10, mins, rating, avail, stock)
                                  for p, price, mins, rating, avail, stock in entries], FIELDS)


@pytest.mark.parametrize("sliders,expected", [((50, 30, 20), (0.5, 0.3, 0.2)), ((0, 0, 0), (1 / 3,) * 3), ((1, 0, 0), (1, 0, 0))])
def test_weights(spark, sliders, expected):
    row = spark.range(1).select(*[c.alias(n) for n, c in S.weight_columns(*sliders).items()]).first()
    assert tuple(row) == pytest.approx(expected) and sum(row) == pytest.approx(1)


def test_scores_by_hand(spark):
    df = rows(spark, ("alpha", 30.0, 10, 4.0, 1.0, True), ("beta", 20.0, 20, 5.0, 0.5, True), ("gamma", 25.0, 15, 3.0, 0.8, False))
    got = {r.platform: r for r in S.score_platforms(df).collect()}
    assert (got["alpha"].price_score, got["alpha"].delivery_score, got["alpha"].quality_score) == (0.0, 1.0, 0.9)
    assert (got["beta"].price_score, got["beta"].delivery_score, got["beta"].quality_score) == (1.0, 0.0, 0.75)
    assert got["gamma"].quality_score == 0.0
    assert [got[p].composite_score for p in ("alpha", "beta", "gamma")] == [0.48, 0.65, 0.4]
    assert [got[p]["rank"] for p in ("alpha", "beta", "gamma")] == [2, 1, 3]


def test_one_platform_and_equal_values_score_one(spark):
    alone = S.score_platforms(rows(spark, ("alpha", 30.0, 10, 4.0, 1.0, True))).first()
    assert alone.price_score == alone.delivery_score == 1.0
    assert S.recommend(S.score_platforms(rows(spark, ("alpha", 30.0, 10, 4.0, 1.0, True)))).first().only_here
    tie = S.score_platforms(rows(spark, ("beta", 3.0, 9, 4.0, 1.0, True), ("alpha", 3.0, 9, 4.0, 1.0, True)))
    assert [r.platform for r in tie.orderBy("rank").collect()] == ["alpha", "beta"]


def test_unavailable_last_is_an_option(spark):
    df = rows(spark, ("alpha", 10.0, 10, 5.0, 1.0, False), ("beta", 30.0, 30, 1.0, 0.0, True))
    assert S.score_platforms(df).orderBy("rank").first().platform == "alpha"
    assert S.score_platforms(df, rank_last_if_unavailable=True).orderBy("rank").first().platform == "beta"


def test_random_packs_against_plain_python(spark):
    rng = random.Random(11)
    packs = {}
    for n in range(60):
        platforms = rng.sample(["alpha", "beta", "gamma"], rng.randint(1, 3))
        packs[n] = [(p, float(rng.randint(10, 13)), rng.randint(7, 9), rng.randint(10, 50) / 10, rng.randint(0, 20) / 20,
                     rng.random() < 0.8) for p in platforms]
    df = rows(spark, *packs[0], pack=0)
    for n in range(1, 60):
        df = df.unionByName(rows(spark, *packs[n], pack=n)) if n < 12 else df
    records = {r.pack_size: r for r in S.recommend(S.score_platforms(df)).collect()}
    for n in range(12):
        entries = packs[n]
        def scaled(values):
            low, high = min(values), max(values)
            return [1.0 if high == low else 1 - (v - low) / (high - low) for v in values]
        price, mins = scaled([e[1] for e in entries]), scaled([e[2] for e in entries])
        quality = [0.5 * e[3] / 5 + 0.5 * e[4] if e[5] else 0.0 for e in entries]
        total = [0.5 * a + 0.3 * b + 0.2 * c for a, b, c in zip(price, mins, quality)]
        got = {p["platform"]: p for p in records[n].platforms}
        for e, t, q in zip(entries, total, quality):
            assert got[e[0]]["composite_score"] == pytest.approx(t, abs=6e-5)
            assert got[e[0]]["quality_score"] == pytest.approx(q, abs=6e-5)
        ranked = sorted(got.values(), key=lambda p: (-p["composite_score"], p["platform"]))
        assert [p["platform"] for p in records[n].platforms] == [p["platform"] for p in ranked]
        assert records[n].best_price_platform == min(ranked, key=lambda p: p["price"])["platform"]
        assert records[n].fastest_delivery_platform == min(ranked, key=lambda p: p["delivery_minutes"])["platform"]
        assert records[n].highest_quality_platform == max(ranked, key=lambda p: p["quality_score"])["platform"]


def test_sentences(spark):
    names = D.platform_names(spark, {"alpha": "Alpha", "beta": "Beta Market"})
    both = rows(spark, ("alpha", 32.5, 10, 4.25, 1.0, True), ("beta", 20.4, 60, 1.0, 0.0, True))
    records = S.recommend(S.score_platforms(both, (10, 80, 10)))
    text = S.answer_text(records, names, "Old Town").first().sentence
    assert text == ("For Milk 500ml in Old Town, Alpha is the best option — ₹32, 10-minute delivery, rated 4.2/5."
                    " However, Beta Market has the lowest price at ₹20.")
    single = S.recommend(S.score_platforms(rows(spark, ("zeta", 33.5, 10, 4.0, 1.0, True))))
    assert "zeta is the best option — ₹34" in S.answer_text(single, names, "Old Town").first().sentence
    empty = records.withColumn("recommended_platform", F.lit(None).cast("string"))
    assert S.answer_text(empty, names, "Old Town").first().sentence == "Sorry, I couldn't find data for Milk."


def test_missing_rating_takes_the_platform_average(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 3.0), ("a", None), ("b", None)], "platform string, rating double")
    got = sorted((r.platform, r.rating) for r in S.impute_rating(df).collect() if r.rating not in (3.0, 4.0))
    assert got == [("a", 3.5), ("b", None)]


def test_stockout_levels(spark, listing):
    from datetime import datetime
    end = datetime(2024, 4, 8)
    df = listing(*[dict(product_name=p, stock_remaining=s, units_ordered=u, snapshot_time=datetime(2024, 4, 7, 12))
                   for p, s, u in (("none", 0, 0), ("short", 5, 168), ("some", 20, 168), ("many", 90, 168), ("unsold", 5, 0))])
    from shelfline.operators.latest import latest_snapshot
    got = {r.product_name: r.stockout_risk for r in S.stockout_risk(df, latest_snapshot(df), F.lit(end)).collect()}
    assert got == {"none": "high", "short": "high", "some": "medium", "many": "low", "unsold": "low"}


def test_defaults(spark):
    latest = spark.createDataFrame([("Milk", "alpha", None, 5.0, None)],
                                   "product_name string, platform string, in_stock boolean, effective_price double, price_per_unit double")
    avail = spark.createDataFrame([], "product_name string, platform string, availability_rate_7d double")
    row = S.with_defaults(latest, avail).first()
    assert (row.in_stock, row.price_per_unit, row.availability_rate_7d) == (True, 5.0, 0.85)


def test_rating_of_a_null_platform(spark):
    df = spark.createDataFrame([(None, None), (None, 2.0), ("a", None), ("a", 4.25)], "platform string, rating double")
    got = sorted(((r.platform or ""), (r.rating or 0.0)) for r in S.impute_rating(df).collect())
    assert got == [("", 0.0), ("", 2.0), ("a", 4.25), ("a", 4.25)]
