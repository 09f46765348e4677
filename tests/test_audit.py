import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.operators import quality as Q
from shelfline.plans import jobs, refresh
from shelfline.plans.refresh import Store

DAY = datetime(2024, 4, 1, 9)


def by_platform(df):
    return {"all" if r.is_overall else r.platform: r for r in df.collect()}


def test_merged_summaries(listing):
    rnd = random.Random(2)
    rows = [dict(platform=rnd.choice(["alpha", "beta", None]), product_name=rnd.choice(["Milk", "Oil", "Tea", None]),
                 snapshot_time=DAY + timedelta(hours=rnd.randrange(200)), delivery_minutes=rnd.choice([3, None])) for _ in range(90)]
    got = by_platform(Q.audit_overall(Q.audit_states(listing(*rows), F.to_date("snapshot_time").alias("date"), "platform")))
    assert set(got) == {"all", "alpha", "beta", None}
    for name, r in got.items():
        mine = [x for x in rows if name == "all" or x["platform"] == name]
        assert r.n_rows == len(mine) and r.platforms == (2 if name == "all" else 1)
        assert (r.first_time, r.last_time) == (min(x["snapshot_time"] for x in mine), max(x["snapshot_time"] for x in mine))
        assert r.unparsed_minutes == sum(x["delivery_minutes"] is None for x in mine)
        assert r.products == len({x["product_name"] for x in mine} - {None})


@pytest.mark.parametrize("distinct", [50, 5_000, 200_000])
def test_the_error_is_bounded(spark, listing, distinct):
    plain = listing(dict(platform="alpha"))
    rows = plain.withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(2 * distinct)))).withColumns({
        "product_name": (F.col("id") % distinct).cast("string"), "platform": F.concat(F.lit("p"), F.col("id") % 7)})
    got = by_platform(Q.audit_overall(Q.audit_states(rows, "platform", F.hash("product_name") % 5)))
    assert abs(got["all"].products - distinct) <= Q.SKETCH_ERROR * distinct
    assert got["all"].platforms == 7


def test_no_rows(listing):
    got = by_platform(Q.audit_overall(Q.audit_states(listing(dict()).limit(0), "platform")))
    assert all(r.n_rows == 0 and r.products == 0 for r in got.values())


def test_batches_change_the_summaries(spark, tmp_path, listing):
    rows = [dict(record_id=f"r{i}", snapshot_time=DAY + timedelta(days=i % 4), product_name=f"p{i % 9}", platform="ab"[i % 2])
            for i in range(40)]
    store = Store(str(tmp_path / "store"))
    refresh.rebuild(listing(*rows[:20]), store)
    late = listing(*rows[20:]).withColumn("record_id", F.concat(F.lit("s"), "record_id"))
    # The second batch brings stored rows once more, so some of their folders may be written anew.
    refresh.refresh(late, store, 1)
    refresh.refresh(listing(*rows[:5]).withColumn("location", F.lit("A")).unionByName(late), store, 2)
    whole = refresh.read(spark, store, "unified")
    want = by_platform(Q.audit_overall(Q.audit_states(whole, "platform")))
    assert by_platform(refresh.audit(spark, store)) == want and want["all"].n_rows == whole.count()
    newest = spark.range(1).select(refresh.newest(spark, store)).first()[0]
    assert newest == DAY + timedelta(days=3)
    # The bound comes from the summaries: the only scan of the rows is the one with the folder filter.
    recent = jobs.load_recent(spark, store, 1)
    plan = spark._jvm.PythonSQLUtils.explainString(recent._jdf.queryExecution(), "formatted")
    assert "/states_audit]" in plan and plan.count("/processed/unified]") == 1
    assert recent.count() == whole.filter(F.col("snapshot_time") >= F.lit(DAY + timedelta(days=2))).count()
