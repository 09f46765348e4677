import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfline.streaming import replay as ST

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp, user_id int, event_type string, value double"


def staged(spark, tmp_path, batches):
    """One file per batch, oldest first by modification time."""
    path = str(tmp_path / "events")
    for n, rows in enumerate(batches):
        part = str(tmp_path / f"part{n}")
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(part)
        os.makedirs(path, exist_ok=True)
        source = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{path}/{n:03d}.parquet"
        with open(f"{part}/{source}", "rb") as a, open(target, "wb") as b:
            b.write(a.read())
        os.utime(target, (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))
    return path


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_batches_in_order_equal_one_batch(spark, tmp_path):
    rows = [(i, at(i * 7), i % 3, "view" if i % 2 else "click", float(i)) for i in range(120)]
    path = staged(spark, tmp_path, [rows[i:i + 30] for i in range(0, 120, 30)])
    got = ST.replay(ST.tumbling_counts(ST.stream_of(spark, path, files_per_batch=1)), "t")
    batch = ST.tumbling_counts(spark.read.parquet(path))
    last = rows[-1][1] - timedelta(minutes=10)
    closed = batch.filter(F.col("window_start") + F.expr("interval 15 minutes") <= F.lit(last))
    key = lambda r: (r.window_start, r.event_type)
    assert sorted(got.collect(), key=key) == sorted(closed.collect(), key=key)


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    # Operators compare with the watermark of the batch before, hence the batch between.
    path = staged(spark, tmp_path, [[(1, at(0), 1, "view", 1.0)], [(2, at(120), 1, "view", 1.0)], [(6, at(121), 1, "view", 1.0)],
                                    [(3, at(1), 1, "view", 1.0), (4, at(118), 1, "view", 1.0)], [(5, at(400), 1, "view", 1.0)]])
    got = ST.replay(ST.tumbling_counts(ST.stream_of(spark, path, files_per_batch=1)), "late")
    counts = {r.window_start: r.events for r in got.collect()}
    # Event 3 comes after its window was closed; event 4 is late too, but within the delay.
    assert counts == {at(0): 1, at(105): 1, at(120): 2}


def test_dedup_over_batches(spark, tmp_path):
    path = staged(spark, tmp_path, [[(1, at(0), 1, "v", 1.0), (1, at(0), 1, "v", 1.0)], [(1, at(1), 1, "v", 1.0), (2, at(2), 1, "v", 1.0)]])
    got = ST.replay(ST.deduplicated(ST.stream_of(spark, path, files_per_batch=1)), "dedup")
    assert sorted(r.event_id for r in got.collect()) == [1, 2]


def test_sessions_over_batches(spark, tmp_path):
    path = staged(spark, tmp_path, [[(1, at(0), 1, "v", 1.0), (2, at(5), 2, "v", 1.0)], [(3, at(20), 1, "v", 1.0)], [(4, at(300), 3, "v", 1.0)]])
    got = ST.replay(ST.session_windows(ST.stream_of(spark, path, files_per_batch=1)), "sessions").collect()
    assert {(r.user_id, r.session_start, r.session_end, r.events) for r in got} == {(1, at(0), at(50), 2), (2, at(5), at(35), 1)}


def test_sliding_availability_counts_each_row_24_times(spark, tmp_path, listing):
    path = str(tmp_path / "listings")
    listing(*[dict(snapshot_time=START + timedelta(hours=h), in_stock=h % 4 != 0) for h in range(0, 100, 5)]).write.parquet(path)
    got = ST.replay(ST.sliding_availability(ST.stream_of(spark, path)), "sliding").collect()
    first = [r for r in got if r.window_start <= START < r.window_end]
    assert len(first) == 24
    whole = next(r for r in got if r.window_start == START)
    assert whole.record_count == 5 and whole.availability_24h == 3 / 5


def test_windows_open_at_the_end_are_added(spark, tmp_path):
    rows = [(i, at(i * 7), i % 3, "view" if i % 2 else "click", float(i)) for i in range(120)]
    path = staged(spark, tmp_path, [rows[i:i + 30] for i in range(0, 120, 30)])
    end = F.col("window_start") + F.expr("interval 15 minutes")
    batch = spark.read.parquet(path)
    got = ST.replay_whole(ST.tumbling_counts, ST.stream_of(spark, path, files_per_batch=1), batch, end, "whole")
    want = ST.tumbling_counts(batch)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.agg(F.sum("events")).first()[0] == 120
