import random
from fractions import Fraction

import pytest

from shelfline.operators import envelope as EV
from test_score import FIELDS, rows


def points(entries):
    """Sub-scores of one pack in ten-thousandths, by hand."""
    def relative(values):
        low, high = min(values), max(values)
        return [1.0 if high == low else 1.0 - (v - low) / (high - low) for v in values]

    price, delivery = relative([e[1] for e in entries]), relative([e[2] for e in entries])
    quality = [0.5 * (e[3] / 5.0) + 0.5 * e[4] if e[5] else 0.0 for e in entries]
    return {e[0]: tuple(int(x * 10_000 + 0.5) for x in t) for e, t in zip(entries, zip(price, delivery, quality))}


def grid(entries, sliders):
    """Winner at each of the 101 settings of each slider."""
    out = {}
    for moved, name in enumerate(EV.SLIDERS):
        for setting in range(101):
            weights = [setting if i == moved else s for i, s in enumerate(sliders)]
            weights = weights if sum(weights) else [1, 1, 1]
            score = {p: sum(w * x for w, x in zip(weights, xs)) for p, xs in points(entries).items()}
            out[name, setting] = min(score, key=lambda p: (-score[p], p))
    return out


def expanded(found):
    out = {}
    for r in found:
        for setting in range(r.from_setting, r.to_setting + 1):
            assert (r.slider, setting) not in out
            out[r.slider, setting] = r.winner
    return out


@pytest.mark.parametrize("sliders", [(50, 30, 20), (1, 0, 7), (0, 100, 0), (0, 0, 0)])
def test_every_setting_of_random_packs(spark, sliders):
    rnd = random.Random(9)
    packs = {}
    for pack in range(25):
        packs[pack] = [(f"p{i}", float(rnd.randint(10, 14)), rnd.randint(5, 9), rnd.randint(2, 10) / 2, rnd.choice([0.0, 0.5, 1.0]),
                        rnd.random() < 0.8) for i in rnd.sample(range(30), rnd.randint(1, 12))]
    df = rows(spark, *packs[0], pack=0)
    for pack in range(1, 25):
        df = df.unionByName(rows(spark, *packs[pack], pack=pack))
    found = {}
    for r in EV.winner_ranges(df, sliders).collect():
        found.setdefault(r.pack_size, []).append(r)
    for pack, entries in packs.items():
        assert expanded(found[pack]) == grid(entries, sliders), pack


def test_the_point_where_two_lines_meet(spark):
    entries = [("alpha", 30.0, 10, 4.0, 1.0, True), ("beta", 20.0, 20, 5.0, 0.5, True)]
    found = {(r.slider, r.range_no): r for r in EV.winner_ranges(rows(spark, *entries)).collect()}
    alpha, beta = points(entries)["alpha"], points(entries)["beta"]
    # price * w + 30 * delivery + 20 * quality is equal for both
    meet = Fraction(30 * (alpha[1] - beta[1]) + 20 * (alpha[2] - beta[2]), beta[0] - alpha[0])
    assert found["price", 0].winner == "alpha" and found["price", 0].meets_at is None
    assert found["price", 1].winner == "beta" and found["price", 1].meets_at == pytest.approx(float(meet))
    assert found["price", 0].to_setting == int(meet) if meet.denominator == 1 else found["price", 1].from_setting == int(meet) + 1


def test_nulls_ties_and_empty(spark):
    same = rows(spark, ("beta", 3.0, 9, 4.0, 1.0, True), ("alpha", 3.0, 9, 4.0, 1.0, True), ("aaa", 3.0, 9, None, 1.0, True))
    got = EV.winner_ranges(same).collect()
    assert {(r.slider, r.winner, r.from_setting, r.to_setting) for r in got} == {(s, "alpha", 0, 100) for s in EV.SLIDERS}
    assert EV.winner_ranges(spark.createDataFrame([], FIELDS)).count() == 0
    assert EV.winner_ranges(rows(spark, ("alpha", 3.0, 9, None, 1.0, True))).count() == 0
    with pytest.raises(ValueError, match="whole"):
        EV.winner_ranges(same, (0.5, 1, 1))
