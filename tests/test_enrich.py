from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfline.functions import listing as L
from shelfline.functions.numbers import exact_avg, round_half_up
from shelfline.operators import enrich as E
from shelfline.sources import dimensions as D


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("hour,factor,peak", [
    (0, 1.60, True), (6, 1.60, True), (7, 1.0, False), (8, 1.35, True), (10, 1.35, True), (11, 1.0, False),
    (12, 1.20, True), (14, 1.20, True), (15, 1.0, False), (18, 1.45, True), (21, 1.45, True), (22, 1.60, True),
    (23, 1.60, True)])
def test_time_band(spark, hour, factor, peak):
    assert one(spark, L.time_band(F.lit(hour))) == factor
    assert one(spark, L.is_peak(F.lit(hour))) is peak


@pytest.mark.parametrize("when,demand,price", [
    (datetime(2024, 1, 1), 1.8, 1.15), (datetime(2024, 1, 3, 23, 59), 1.8, 1.15), (datetime(2024, 1, 4), 1.0, 1.0),
    (datetime(2024, 3, 24, 23, 59), 1.0, 1.0), (datetime(2024, 3, 25), 1.4, 1.05), (datetime(2024, 5, 23, 23), 1.4, 1.05),
    (datetime(2024, 5, 24), 1.0, 1.0), (datetime(2023, 12, 27, 12), 1.5, 1.12), (datetime(2023, 12, 28), 1.0, 1.0),
    (datetime(1989, 12, 25), 1.5, 1.12), (datetime(2051, 1, 1), 1.8, 1.15)])
def test_festival_boundaries(spark, when, demand, price):
    df = spark.createDataFrame([(when,)], "snapshot_time timestamp")
    row = E.add_festival(df).first()
    assert (row.festival_demand_mult, row.festival_price_mult) == (demand, price)


def test_first_of_two_overlapping_festivals_holds(spark):
    days = spark.createDataFrame([(datetime(2024, 5, d),) for d in range(1, 7)], "snapshot_time timestamp")
    out = E.add_festival(days, festivals=((5, 1, 2.0, 1.1, 3), (5, 2, 9.0, 9.9, 3)))
    got = {r.snapshot_time.day: r.festival_demand_mult for r in out.collect()}
    assert got == {1: 2.0, 2: 2.0, 3: 2.0, 4: 9.0, 5: 1.0, 6: 1.0}


def test_festival_ends_with_its_year_and_needs_no_join(spark):
    df = spark.createDataFrame([(datetime(2024, 12, 31),), (datetime(2025, 1, 1),), (None,)], "snapshot_time timestamp")
    out = E.add_festival(df, festivals=((12, 31, 2.0, 1.1, 3),))
    assert [r.festival_demand_mult for r in out.orderBy("snapshot_time").collect()] == [1.0, 2.0, 1.0]
    assert "Join" not in spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")


def test_season_weather_and_premium(spark):
    df = spark.createDataFrame([("Mango", 4), ("Mango", 12), ("Salt", 4)], "product_name string, month int")
    got = [r.seasonal_factor for r in E.add_season(df, D.seasonal_table(spark)).orderBy("product_name", "month").collect()]
    assert got == [0.7, 1.9, 1.0]
    assert E.add_weather(df, D.weather_table(spark)).filter("month = 12").first().weather == "Clear"
    assert one(spark, L.weekend_premium(F.lit(True), F.lit("Dairy"), F.lit(11))) == 1.04
    assert one(spark, L.weekend_premium(F.lit(True), F.lit("Dairy"), F.lit(12))) == 1.0
    assert one(spark, L.weekend_premium(F.lit(False), F.lit("Dairy"), F.lit(9))) == 1.0


def test_packs(spark):
    df = spark.createDataFrame([("Milk", 500, "ml", [200, 500, 1000]), ("Aid", 10, "pcs", [10]), ("Box", 5, "g", [20])],
                               "product_name string, base_size int, pack_unit string, pack_sizes array<int>")
    rows = {(r.product_name, r.pack_size): r for r in E.add_bulk_discount(E.explode_packs(df)).collect()}
    assert len(rows) == 5 and rows["Milk", 200].pack_label == "200ml" and rows["Milk", 1000].size_ratio == 2.0
    assert rows["Milk", 1000].bulk_factor == 0.95 and rows["Milk", 1000].bulk_discount_pct == 0.05
    assert rows["Milk", 500].bulk_factor == rows["Milk", 200].bulk_factor == rows["Aid", 10].bulk_factor == 1.0
    # A single size larger than the base: the span is taken as one, and the floor holds.
    assert rows["Box", 20].bulk_factor == 0.9


@pytest.mark.parametrize("base,hour,weekend,rain,expected", [
    (15, 7, False, False, 15), (15, 9, False, False, 20), (40, 23, True, True, 60), (5, 7, False, False, 7)])
def test_adjusted_minutes(spark, base, hour, weekend, rain, expected):
    got = one(spark, L.adjusted_minutes(F.lit(base), F.lit(hour), F.lit(weekend), F.lit(rain), F.lit(1.3)))
    assert got == expected


def test_prices(spark):
    assert one(spark, L.net_price(F.lit(99.0), F.lit(15))) == 84.15
    assert one(spark, L.unit_price(F.lit(10.0), F.lit(3))) == 3.3333
    assert one(spark, L.unit_price(F.lit(10.0), F.lit(0))) is None
    assert one(spark, L.sold_units(F.lit(3), F.lit(1.8), F.lit(9))) == 5
    assert one(spark, L.sold_units(F.lit(3), F.lit(1.8), F.lit(4))) == 4
    assert one(spark, round_half_up(F.lit(0.125), 2)) == 0.13


def test_average_does_not_depend_on_partitions(spark):
    df = spark.range(10_000).select((F.col("id") % 997 / 100.0).alias("x"))
    values = {df.repartition(n).agg(exact_avg("x", 2).alias("a")).first().a for n in (1, 2, 7, 16)}
    assert len(values) == 1


def test_sums_cut_nothing_and_keep_nan_in_its_group(spark):
    import math
    df = spark.createDataFrame([("a", 4.25), ("a", 4.25), ("b", float("nan")), ("b", 1.0), ("c", 10.005), ("d", None)],
                               "k string, v double")
    got = {r.k: r.a for r in df.groupBy("k").agg(exact_avg("v", 1).alias("a")).collect()}
    assert math.isnan(got.pop("b")) and got == {"a": 4.25, "c": 10.005, "d": None}
