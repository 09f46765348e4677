import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from shelfline.functions.percentiles import exact_percentiles
from shelfline.operators import usage as U

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp, user_id int, event_type string, value double"


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def random_events(n=800, seed=2):
    rng = random.Random(seed)
    # One user has a third of the events; many gaps are exactly 30 minutes.
    return [(i, START + timedelta(minutes=rng.randrange(0, 6000, 15), microseconds=rng.choice((0, 0, 1))),
             0 if i % 3 == 0 else rng.randrange(1, 9), rng.choice(("view", "click", "purchase")), rng.random())
            for i in range(n)]


def brute_sessions(rows, gap=timedelta(minutes=30)):
    out = []
    for user in {r[2] for r in rows}:
        times = sorted((r[1], r[3]) for r in rows if r[2] == user)
        session = [times[0]]
        for t in times[1:]:
            if t[0] - session[-1][0] > gap:
                out.append((user, session))
                session = []
            session.append(t)
        out.append((user, session))
    return {(u, s[0][0], s[-1][0], len(s), sum(k == "view" for _, k in s)) for u, s in out}


def test_sessions_against_brute_force(spark):
    rows = random_events()
    got = U.sessions(events(spark, rows)).collect()
    assert {(r.user_id, r.session_start, r.session_end, r.events, r["view"]) for r in got} == brute_sessions(rows)
    assert len(got) == len({(r.user_id, r.session_no) for r in got})


def test_session_measures(spark):
    rows = [(1, START, 1, "view", 1.0), (2, START + timedelta(minutes=10), 1, "click", 1.0),
            (3, START + timedelta(hours=2), 1, "view", 1.0), (4, START, 2, "view", 1.0)]
    per = U.sessions(events(spark, rows))
    share = {r.event_type: r.share for r in U.session_share(per).collect()}
    mean = {r.event_type: r.events_per_session for r in U.events_per_session(per).collect()}
    assert share["view"] == 1.0 and share["click"] == 1 / 3 and mean["view"] == 1.0 and mean["signup"] == 0.0
    assert U.session_summary(per).first().mean_duration_sec == 200.0


def test_return_rate(spark):
    day = timedelta(days=1)
    rows = [(1, START, 1, "v", 0.0), (2, START + 7 * day, 1, "v", 0.0), (3, START, 2, "v", 0.0), (4, START + 8 * day, 2, "v", 0.0),
            (5, START, 3, "v", 0.0), (6, START + timedelta(hours=5), 3, "v", 0.0)]
    row = U.return_rate(events(spark, rows)).first()
    assert (row.users, row.returned) == (3, 1)


@pytest.mark.parametrize("small", [10_000, 5])
def test_percentiles_against_numpy(spark, small):
    rng = random.Random(4)
    groups = {"hot": [round(rng.lognormvariate(1, 2), 2) for _ in range(20_000)], "tie": [5.0] * 3000 + [7.0] * 20,
              "one": [3.0], "two": [1.0, 2.0], "neg": [-float(i) for i in range(2000)]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(6)
    out = exact_percentiles(df, ["k"], "v", {"low": 0.05, "mid": 0.5, "high": 0.95, "top": 1.0},
                            small_group=small if small > 5 else 2500).collect()
    for r in out:
        want = np.quantile(groups[r.k], [0.05, 0.5, 0.95, 1.0])
        assert [r.low, r.mid, r.high, r.top] == pytest.approx(list(want), rel=1e-12)
    assert len(out) == len(groups)


def test_percentile_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0)], "k string, v double")
    assert exact_percentiles(df, ["k"], "v", {"p": 0.5}).first().p == 2.0


def test_late_rows_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, START + timedelta(minutes=rng.randrange(3000)), 1, "v", 0.0) for i in range(400)]
    lag = {i: timedelta(minutes=rng.randrange(200)) for i in range(400)}
    df = spark.createDataFrame([(*r, r[1] + lag[r[0]]) for r in rows], SCHEMA + ", arrived timestamp")
    got = {r.event_id for r in U.late_rows(df, "arrived", U.batch_watermarks(df, "arrived")).collect()}
    slot = {r[0]: int((r[1] + lag[r[0]]).timestamp() // 3600) for r in rows}
    want = set()
    for r in rows:
        earlier = [o[1] for o in rows if slot[o[0]] < slot[r[0]]]
        if earlier and r[1] < max(earlier) - timedelta(minutes=30):
            want.add(r[0])
    assert got == want and want


def test_monthly_users(spark):
    rows = [(1, START, 1, "v", 0.0), (2, START, 1, "v", 0.0), (3, datetime(2024, 2, 1), 2, "v", 0.0)]
    assert {(r.month, r.active_users) for r in U.monthly_active_users(events(spark, rows)).collect()} == {("2024-01", 1), ("2024-02", 1)}


def test_percentile_of_the_null_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), (None, 5.0), (None, 7.0)], "k string, v double")
    assert {r.k: r.p for r in exact_percentiles(df, ["k"], "v", {"p": 0.5}).collect()} == {"x": 1.5, None: 6.0}


def test_measures_of_types_that_no_list_names(spark):
    rows = [(1, START, 1, "view", 1.0), (2, START + timedelta(minutes=25), 1, "share", 1.0), (3, START + timedelta(minutes=50), 1, "share", 1.0),
            (4, START + timedelta(hours=3), 1, None, 1.0), (5, START, 2, "events", 1.0), (6, START, 3, "share", 1.0)]
    per = U.sessions(events(spark, rows))
    share = {r.event_type: (r.sessions, r.share) for r in U.session_share(per).collect()}
    mean = {r.event_type: r.events_per_session for r in U.events_per_session(per).collect()}
    want = {"view": 1, "share": 2, "events": 1, None: 1, "click": 0, "signup": 0, "purchase": 0, "error": 0}
    assert share == {t: (4, n / 4) for t, n in want.items()}
    assert mean == {t: (3 if t == "share" else n) / 4 for t, n in want.items()}
    assert sorted(r.events for r in per.collect()) == [1, 1, 1, 3]
    assert U.session_share(U.sessions(events(spark, rows[:0]))).count() == 0
