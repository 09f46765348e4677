"""Every query against its SQL equivalent, and the shape of every plan."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck_views  # noqa: E402

from shelfline.plans.oracles import ORACLES  # noqa: E402
from shelfline.plans.queries import QUERIES  # noqa: E402

MODELS = {"indexed_features", "demand_forecast", "trend_classify", "horizon_forecast", "forecast_record_model"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_views(sf_dir)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == MODELS and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, sf_dir, name):
    result = compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])
    assert re.fullmatch(r"ok [1-9]\d*", result), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert word not in plan


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    assert entry(spark).count() == 3
    assert queries().keys() >= QUERIES.keys() and oracle_sql().items() >= ORACLES.items()


def test_events_reach_the_scan_pruned(spark, sf_dir):
    plan = spark._jvm.PythonSQLUtils.explainString(QUERIES["mau"](spark, sf_dir)._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_as_of_prices_of_every_pair_of_platforms(spark, sf_dir):
    from shelfline.sources import testtables as T
    rows = {r.platform: r["count"] for r in T.listings(spark, sf_dir).groupBy("platform").count().collect()}
    got = QUERIES["asof_price_all"](spark, sf_dir).groupBy("platform", "ref_platform").count().collect()
    assert {(r.platform, r.ref_platform): r["count"] for r in got} == {(a, b): rows[a] for a in rows for b in rows}


def test_gaps_and_observed_slots_fill_the_grid(spark, sf_dir):
    from pyspark.sql import functions as F

    from shelfline.schema import PACK_KEY
    from shelfline.sources import testtables as T
    step = F.floor(F.unix_timestamp("snapshot_time") / 900).alias("step")
    seen = T.listings(spark, sf_dir).select(*PACK_KEY, "platform", step).distinct()
    low, high = seen.agg(F.min("step"), F.max("step")).first()
    packs = seen.select(*PACK_KEY).distinct().count()
    missing = QUERIES["slot_gaps_all"](spark, sf_dir).agg(F.sum("missing")).first()[0]
    assert missing + seen.count() == packs * len(T.PLATFORMS) * (high - low + 1)
