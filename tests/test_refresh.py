"""States of parts, merged, against aggregates over all rows; batches against a full run."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.operators import aggregate as A
from shelfline.operators import normalise as N
from shelfline.operators import partials as P
from shelfline.plans import jobs, refresh

DAY = datetime(2024, 4, 1, 9)


def rows_of(df):
    return sorted((str(sorted(r.asDict().items())) for r in df.collect()))


def some(rng, i, day, **more):
    row = dict(record_id=f"r{i}", snapshot_time=DAY + timedelta(days=day, hours=rng.randrange(3)), hour_of_day=9 + rng.randrange(2),
               product_name=rng.choice(["Milk", "Bread", None]), category=rng.choice(["Dairy", None]), platform=rng.choice(["alpha", "beta"]),
               effective_price=rng.choice([10.0, 20.01, 31.99, None]), price_per_unit=rng.choice([0.0612, None]),
               discount_pct=rng.choice([0.0, 12.5]), in_stock=rng.choice([True, False, None]), stock_remaining=rng.choice([3, None]),
               units_ordered=rng.choice([1, 4, None]), revenue_inr=rng.choice([60.07, None]), delivery_minutes=rng.choice([15, None]))
    return {**row, **more}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [some(rng, i, i % 5) for i in range(120)]


TABLES = {"price_analytics": A.price_analytics, "delivery_analytics": A.delivery_analytics, "revenue_analytics": A.revenue_analytics,
          "stock_analytics": A.stock_analytics, "daily_demand": A.daily_demand}


@pytest.mark.parametrize("name", TABLES)
def test_merged_states_equal_the_aggregate(listing, rows, name):
    df, summary = listing(*rows), P.SUMMARIES[name]
    parts = P.states(summary, df.filter("record_id < 'r5'")).unionByName(P.states(summary, df.filter("record_id >= 'r5'")))
    got = P.finished(summary, P.merged(summary, parts))
    assert rows_of(got) == rows_of(P.table(summary, df))
    want = TABLES[name](df).select(got.columns)
    assert [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    exact = [c for c in got.columns if c != "price_stddev"]
    assert rows_of(got.select(exact)) == rows_of(want.select(exact))
    if "price_stddev" in got.columns:
        near = [F.round("price_stddev", 9).alias("s"), "product_name", "category", "platform", "date", "hour"]
        assert rows_of(got.select(near)) == rows_of(want.select(near))


def test_states_of_other_values(listing):
    """More decimals, NaN and sums beyond a long: doubles, merged pairwise."""
    values = [1.23456, 2.0, 3.5, 1e17, 7.25, 9.125]
    df = listing(*[dict(effective_price=v, record_id=f"r{i}") for i, v in enumerate(values)])
    parts = [P.states(P.PRICES, df.filter(F.col("record_id") == f"r{i}")) for i in range(6)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    row = P.finished(P.PRICES, P.merged(P.PRICES, both)).first()
    want = A.price_analytics(df).first()
    assert row.avg_price == pytest.approx(want.avg_price) and row.price_stddev == pytest.approx(want.price_stddev)
    nan = listing(dict(effective_price=float("nan")), dict(effective_price=1.0))
    assert str(P.table(P.PRICES, nan).first().avg_price) == "nan"
    equal = listing(*[dict(effective_price=0.1)] * 7)
    assert P.table(P.PRICES, equal).first().price_stddev == 0.0


def _tables(spark, store):
    out = {"unified": jobs.load_unified(spark, store)}
    return {**out, **{n: refresh.read(spark, store, n) for n in jobs.AGGREGATES}}


def _files(store, name):
    import glob
    return {f for f in glob.glob(f"{store.processed(name)}/**/*.parquet", recursive=True)}


def test_batches_equal_a_full_run(spark, listing, rows, tmp_path):
    rng = random.Random(8)
    late = [some(rng, 500 + i, 1) for i in range(9)]
    day = [some(rng, 600 + i, 5) for i in range(20)]
    again = [rows[3], rows[4], day[0]]  # equal copies of stored rows
    lower = {**rows[6], "location": "A first copy"}  # sorts before the stored copy, so it replaces it
    higher = {**rows[7], "location": "Zzz"}
    store, full = jobs.Store(str(tmp_path / "store")), jobs.Store(str(tmp_path / "full"))
    refresh.rebuild(N.deduplicate(listing(*rows)), store)
    before = {n: _files(store, n) for n in jobs.AGGREGATES}

    assert refresh.refresh(listing(*day), store, 1) == {"new": 20, "touched": 2, "rewritten": 0}
    for n in jobs.AGGREGATES:  # only the folders of the new day are written
        assert before[n] <= _files(store, n) and all("date=2024-04-06" in f for f in _files(store, n) - before[n])
    out = refresh.refresh(listing(*late, *again), store, 2)
    assert out["new"] == 9 and out["rewritten"] == 0
    refresh.refresh(listing(lower, higher), store, 3)
    refresh.refresh(listing(lower, higher), store, 3)  # a batch that is run again
    refresh.refresh(listing(*late, *again), store, 2)  # and an earlier one
    assert refresh.refresh(listing(*rows).limit(0), store, 4)["touched"] == 0

    refresh.rebuild(N.deduplicate(listing(*rows, *day, *late, *again, lower, higher)), full)
    kept, want = _tables(spark, store), _tables(spark, full)
    for name in want:
        assert rows_of(kept[name].drop("batch")) == rows_of(want[name].drop("batch")), name
    with pytest.raises(ValueError):
        refresh.refresh(listing(*day), store, 0)


def test_batches_leave_other_days_of_a_folder_alone(spark, listing, rows, tmp_path):
    store, full = jobs.Store(str(tmp_path / "store"), ("platform",)), jobs.Store(str(tmp_path / "full"), ("platform",))
    late = [some(random.Random(3), 700 + i, 1 + 6 * (i % 2)) for i in range(12)]  # of a stored day and of a new one
    lower = {**rows[6], "location": "A first copy"}
    refresh.rebuild(N.deduplicate(listing(*rows)), store)
    before = {n: _files(store, n) for n in jobs.AGGREGATES}
    refresh.refresh(listing(*late), store, 1)
    assert all(before[n] <= _files(store, n) for n in jobs.AGGREGATES)
    days = {r.date for r in spark.read.parquet(*[f for f in _files(store, "daily_demand") - before["daily_demand"]]).select("date").collect()}
    assert days == {(DAY + timedelta(days=d)).date() for d in (1, 7)}
    assert refresh.refresh(listing(lower, late[0]), store, 2)["rewritten"] == 1
    refresh.refresh(listing(*late), store, 1)
    refresh.rebuild(N.deduplicate(listing(*rows, *late, lower)), full)
    kept, want = _tables(spark, store), _tables(spark, full)
    for name in want:
        assert rows_of(kept[name].drop("batch")) == rows_of(want[name].drop("batch")), name


def test_refresh_reads_touched_folders_only(spark, listing, rows, tmp_path):
    store = jobs.Store(str(tmp_path / "store"))
    refresh.rebuild(N.deduplicate(listing(*rows)), store)
    parts = refresh._in_folders(refresh.read(spark, store, "states_price_analytics"), store, [dict(date=DAY.date(), platform="beta")])
    plan = spark._jvm.PythonSQLUtils.explainString(parts._jdf.queryExecution(), "formatted")
    filters = plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert "date" in filters and "platform" in filters and "beta" in filters
