import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.streaming import ledger as LG
from shelfline.streaming import replay as ST
from test_streaming import SCHEMA, at, staged


def whole(spark, rows):
    """Counts per window and type by hand."""
    out = {}
    for _, ts, _, kind, _ in rows:
        key = (ts.replace(minute=ts.minute // 15 * 15, second=0, microsecond=0), kind)
        out[key] = out.get(key, 0) + 1
    return out


def counts(spark, path):
    return {(r.window_start, r.event_type): r.events for r in LG.results(spark, LG.tumbling_counts(), path).collect()}


@pytest.fixture
def late_batches():
    """Three batches; events 3 and 7 come after their windows were closed, event 4 is late but within the delay."""
    return [[(1, at(0), 1, "view", 1.0), (2, at(120), 1, "view", 2.0)],
            [(3, at(1), 1, "view", 1.0), (4, at(118), 1, "view", 1.0), (8, None, 1, "view", 1.0)],
            [(5, at(400), 2, None, None), (7, at(0), 1, "view", 1.0)]]


def test_one_file_and_many_give_the_same_windows(spark, tmp_path):
    rows = [(i, at(i * 7), i % 3, "view" if i % 2 else "click", float(i)) for i in range(120)]
    one, many = (staged(spark, tmp_path / n, parts) for n, parts in (
        ("one", [rows]), ("many", [rows[i:i + 30] for i in range(0, 120, 30)])))
    results = []
    for name, path in (("a", one), ("b", many)):
        LG.run(ST.stream_of(spark, path, files_per_batch=1), LG.tumbling_counts(), str(tmp_path / name))
        results.append(sorted(map(tuple, LG.results(spark, LG.tumbling_counts(), str(tmp_path / name)).collect())))
        assert LG.late_rows(spark, str(tmp_path / name)) is None
    assert results[0] == results[1]
    assert counts(spark, str(tmp_path / "b")) == whole(spark, rows)
    assert LG.ledger(spark, str(tmp_path / "b")).count() == 4


def test_results_and_late_rows_are_the_input(spark, tmp_path, late_batches):
    path, out = staged(spark, tmp_path, late_batches), str(tmp_path / "out")
    LG.run(ST.stream_of(spark, path, files_per_batch=1), LG.tumbling_counts(), out)
    late = {r.event_id: r.batch for r in LG.late_rows(spark, out).collect()}
    assert late == {3: 1, 8: 1, 7: 2}
    in_time = [r for b in late_batches for r in b if r[0] not in late]
    assert counts(spark, out) == whole(spark, in_time)
    lines = [(r.rows_in_time, r.rows_late) for r in LG.ledger(spark, out).orderBy("batch").collect()]
    assert lines == [(2, 0), (1, 2), (1, 1)]


def test_a_repeated_batch_counts_once(spark, tmp_path, late_batches):
    table, out = LG.tumbling_counts(), str(tmp_path / "out")
    batches = [spark.createDataFrame(b, SCHEMA) for b in late_batches]
    for n in (0, 0, 1, 1, 2, 1, 0):
        LG.take(batches[n], n, table, out)
    assert LG.ledger(spark, out).count() == 3 and LG.late_rows(spark, out).count() == 3
    assert sum(counts(spark, out).values()) == 4


def test_a_batch_that_broke_off_is_not_seen_and_is_run_again(spark, tmp_path, late_batches, monkeypatch):
    table, out = LG.tumbling_counts(), str(tmp_path / "out")
    path = staged(spark, tmp_path, late_batches)
    stream = lambda: ST.stream_of(spark, path, files_per_batch=1)
    plain, seen = LG._line, []

    def breaks(session, folder, batch):
        seen.append(batch)
        if batch == 1 and seen.count(1) == 1:
            # States of a run that ended before its line was written.
            table.states(spark.createDataFrame(late_batches[0], SCHEMA).withColumn("is_late", F.lit(False)).withColumn(
                "newest_us", F.unix_micros("ts")), ("is_late",)).write.parquet(f"{out}/states/batch=1")
            raise RuntimeError("lost")
        return plain(session, folder, batch)

    monkeypatch.setattr(LG, "_line", breaks)
    with pytest.raises(Exception, match="lost"):
        LG.run(stream(), table, out)
    assert sum(counts(spark, out).values()) == 2
    LG.run(stream(), table, out)
    LG.run(stream(), table, out)  # nothing new
    assert sum(counts(spark, out).values()) == 4 and LG.late_rows(spark, out).count() == 3


def test_a_gap_in_the_ledger_is_an_error(spark, tmp_path, late_batches):
    with pytest.raises(ValueError, match="batch 4"):
        LG.take(spark.createDataFrame(late_batches[0], SCHEMA), 4, LG.tumbling_counts(), str(tmp_path / "out"))


def test_empty_input(spark, tmp_path):
    out = str(tmp_path / "out")
    LG.take(spark.createDataFrame([], SCHEMA), 0, LG.tumbling_counts(), out)
    assert counts(spark, out) == {} and LG.late_rows(spark, out) is None
    # A later batch has no watermark yet, so nothing is late.
    LG.take(spark.createDataFrame([(1, at(0), 1, "v", 1.0)], SCHEMA), 1, LG.tumbling_counts(), out)
    assert sum(counts(spark, out).values()) == 1


def test_sessions_grow_over_batches(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, at(i * 4 + rnd.randrange(9)), rnd.choice([1, 1, 1, 2, 3]), "v", 1.0) for i in range(200)]
    path, out, table = staged(spark, tmp_path, [rows[i:i + 23] for i in range(0, 200, 23)]), str(tmp_path / "out"), LG.session_windows()
    LG.run(ST.stream_of(spark, path, files_per_batch=1), table, out)
    got = sorted(map(tuple, LG.results(spark, table, out).select("user_id", "session_start", "session_end", "events").collect()))
    want = []
    for user in (1, 2, 3):
        times = sorted(r[1] for r in rows if r[2] == user)
        first = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] > timedelta(minutes=30):
                want.append((user, times[first], times[i - 1] + timedelta(minutes=30), i - first))
                first = i
    assert got == sorted(want)


def test_availability_per_product_and_platform(spark, tmp_path, listing):
    start, out = datetime(2024, 1, 1), str(tmp_path / "out")
    rows = [dict(product_name=p, platform="alpha", snapshot_time=start + timedelta(hours=h), in_stock=s)
            for p, h, s in (("Milk", 0, True), ("Milk", 23, False), ("Milk", 24, None), ("Oil", 24, True), (None, 3, True))]
    table = LG.sliding_availability(by_product=True)
    LG.take(listing(*rows), 0, table, out)
    got = {(r.product_name, r.window_end): (r.availability_24h, r.record_count) for r in LG.results(spark, table, out).collect()}
    end = lambda h: start + timedelta(hours=h + 1)
    # The window that ends with hour 24 has lost hour 0; a null counts in no window.
    assert got == {("Milk", end(0)): (1.0, 1), ("Milk", end(23)): (0.5, 2), ("Milk", end(24)): (0.0, 1),
                   ("Oil", end(24)): (1.0, 1), (None, end(3)): (1.0, 1)}
