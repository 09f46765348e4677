from datetime import datetime

from pyspark.sql import functions as F

from shelfline.operators import normalise as N
from shelfline.operators import quality as Q
from shelfline.schema import CANONICAL, FEED_A, FEED_B, FEED_C


def raw(spark, feed, **values):
    schema = feed.raw_schema()
    back = {name: column for column, name in feed.columns.items()}
    given = {back.get(k, k): v for k, v in values.items()}
    return spark.createDataFrame([tuple(given.get(f.name) for f in schema.fields)], schema)


def test_layouts_have_28_columns_and_cover_the_canonical_ones():
    for feed in (FEED_A, FEED_B, FEED_C):
        assert len(feed.raw_schema()) == 28
        assert set(feed.columns.values()) == set(CANONICAL.names) - {"platform"}


def test_each_layout_becomes_canonical(spark):
    for feed, stock in ((FEED_A, "available"), (FEED_B, "yes"), (FEED_C, True)):
        minutes = "15 mins" if feed.minutes_text else 15
        flag = 1 if feed.int_flags else True
        df = raw(spark, feed, record_id="x", snapshot_time="2024-04-01 09:15:00", in_stock=stock,
                 delivery_minutes=minutes, is_weekend=flag, is_peak_hour=flag, discount_pct=10, pack_size=500)
        out = N.normalise_feed(df, feed, "p")
        assert Q.conforms(out)
        row = out.first()
        assert row.snapshot_time == datetime(2024, 4, 1, 9, 15) and row.platform == "p"
        assert row.in_stock and row.is_weekend and row.is_peak_hour
        assert (row.delivery_minutes, row.discount_pct, row.pack_size) == (15, 10.0, 500)


def test_malformed_values_become_null_or_false(spark):
    df = raw(spark, FEED_C, delivery_minutes="n/a", snapshot_time="yesterday")
    row = N.normalise_feed(df, FEED_C, "p").first()
    assert row.delivery_minutes is None and row.snapshot_time is None
    for word in ("out_of_stock", "AVAILABLE", None):
        assert N.normalise_feed(raw(spark, FEED_A, in_stock=word), FEED_A, "p").first().in_stock is False
    long = raw(spark, FEED_C, delivery_minutes="99999999999 mins")
    assert N.normalise_feed(long, FEED_C, "p").first().delivery_minutes is None


def test_missing_columns_become_typed_nulls(spark):
    df = raw(spark, FEED_B, rating=4.0).drop("app_rating", "month")
    out = N.normalise_feed(df, FEED_B, "p")
    assert Q.conforms(out) and out.first().rating is None
    assert Q.conforms(N.select_canonical(out.drop("weather").withColumn("extra", F.lit(1))))


def test_deduplicate_is_deterministic_and_idempotent(spark, listing):
    df = listing(dict(record_id="a", stock_remaining=5), dict(record_id="a", stock_remaining=3),
                 dict(record_id="a", platform="beta"), dict(record_id="b", snapshot_time=None),
                 dict(record_id="b", snapshot_time=None))
    for n in (1, 3, 7):
        out = N.deduplicate(df.repartition(n))
        assert out.count() == 3
        assert out.filter("record_id = 'a' and platform = 'alpha'").first().stock_remaining == 3
    assert N.deduplicate(out).count() == 3


def test_hot_key_is_trimmed_before_the_shuffle(spark, listing):
    plan = spark._jvm.PythonSQLUtils.explainString(N.deduplicate(listing({})) ._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_duplicate_audit(spark, listing):
    df = listing(dict(record_id="a"), dict(record_id="a"), dict(record_id="b"), dict(record_id="a", platform="beta"))
    rows = {r.platform: (r.rows_in, r.rows_out, r.duplicates) for r in N.duplicate_audit(df).collect()}
    assert rows == {"alpha": (3, 2, 1), "beta": (1, 1, 0)}


def test_lossless_check_sees_lost_and_invented_rows(spark, listing):
    ids = listing(dict(record_id="a"), dict(record_id="b")).select("platform", "record_id")
    row = Q.lossless_check(ids, listing(dict(record_id="b"), dict(record_id="c"))).first()
    assert (row.raw_ids, row.unified_rows, row.lost, row.invented) == (2, 2, 1, 1)


def test_rule_violations(spark, listing):
    df = listing(dict(rating=5.5), dict(delivery_minutes=61), dict(discount_pct=7.0), dict(effective_price=0.0),
                 dict(location="Elsewhere"), dict(rating=None))
    rows = {r.rule: r.violations for r in Q.rule_violations(df, Q.domain_rules("Old Town")).collect()}
    assert rows == {"rating_range": 1, "delivery_range": 1, "discount_step": 1, "price_positive": 1, "location": 1}
