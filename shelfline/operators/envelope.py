"""Where the winner of a pack changes along a slider, exactly.

While one slider moves and the others stay, all platforms' scores have the same divisor, so a platform's score is a line over
the setting: its own sub-score times the setting, plus what the other sliders give.  The winner at every setting is the upper
envelope of the lines of a pack.  Sub-scores count in ten-thousandths, as they are shown, so all comparisons are of whole
numbers, and platforms with equal scores are ordered by name as in the ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.operators.score import sub_scores
from shelfline.schema import PACK_KEY

SLIDERS = ("price", "delivery", "quality")
HIGHEST = 100


def _beats(one: Column, other: Column, setting: Column) -> Column:
    """Once it holds it holds for all higher settings, if ``one`` is not less steep."""
    ahead = setting * (one["slope"] - other["slope"]) + one["base"] - other["base"]
    return (ahead > 0) | ((ahead == 0) & (one["platform"] < other["platform"]))


def _takes_over(one: Column, other: Column, highest: int) -> Column:
    """The first whole setting at which a steeper line beats one that is ahead now; beyond ``highest`` if there is none."""
    gain, behind = one["slope"] - other["slope"], other["base"] - one["base"]
    # ``behind`` is not negative, so this whole division rounds down.
    even = (behind - behind % F.nullif(gain, F.lit(0))) / gain
    first = F.when((even * gain == behind) & (one["platform"] < other["platform"]), even).otherwise(even + 1)
    return F.coalesce(first, F.lit(highest + 1)).cast("bigint")


def _envelope(lines: Column, highest: int) -> Column:
    """Lines that win somewhere, each with the first setting that it wins (``start``).

    Lines come in order of steepness.  A new one wins from some setting on: winners that it beats where they
    start go, and it starts where it beats the last one left.  Each line is looked at once."""
    def add(found: Column, line: Column) -> Column:
        kept = F.filter(found, lambda k: ~_beats(line, k, k["start"]))
        last = F.get(kept, F.size(kept) - 1)
        start = F.when(F.size(kept) == 0, F.lit(0).cast("bigint")).otherwise(_takes_over(line, last, highest))
        return F.when(start > highest, found).otherwise(F.concat(kept, F.array(line.withField("start", start))))

    ordered = F.array_sort(lines)
    return F.reduce(ordered, F.filter(ordered, lambda _: F.lit(False)), add)


def winner_ranges(rows: DataFrame, sliders: tuple[int, int, int] = fv.DEFAULT_WEIGHTS, highest: int = HIGHEST) -> DataFrame:
    """Per pack and slider, the ranges of whole settings (0 to ``highest``) and the platform that wins there while the
    other two sliders stay at ``sliders``.

    ``meets_at``: the setting, mostly between two whole ones, at which the winner's line meets that of the range before;
    null in the first range.  Where both others are zero, the setting zero means a third for each sub-score, and from one on only
    the moved one counts (no lines meet then).  A platform without one of the three sub-scores cannot win; a pack without any other has no row.
    A pack has one entry per platform, so its list is bounded by the number of platforms."""
    if any(s != int(s) or s < 0 for s in sliders):
        raise ValueError("sliders are whole numbers from zero")
    whole = {n: F.floor(F.col(f"_{n}") * F.lit(10_000.0) + F.lit(0.5)).cast("bigint").alias(n) for n in SLIDERS}
    entry = F.struct("platform", *SLIDERS)
    packs = sub_scores(rows).select(*PACK_KEY, "platform", *whole.values()).dropna(subset=["platform", *SLIDERS]).groupBy(
        *PACK_KEY).agg(F.collect_list(entry).alias("entries"))

    def first_by(points) -> Column:
        order = F.transform("entries", lambda e: F.struct((-points(e)).alias("p"), e["platform"].alias("platform")))
        return F.array_min(order)["platform"]

    def alone(name: str) -> Column:
        def won(platform: Column, start: int) -> Column:
            zero = F.lit(0).cast("bigint")
            return F.struct(zero.alias("slope"), zero.alias("base"), platform.alias("platform"), F.lit(start).cast("bigint").alias("start"))

        thirds, only = first_by(lambda e: sum((e[n] for n in SLIDERS[1:]), e[SLIDERS[0]])), first_by(lambda e: e[name])
        return F.when(thirds == only, F.array(won(only, 0))).otherwise(F.array(won(thirds, 0), won(only, 1)))

    def along(moved: int) -> Column:
        def line(e: Column) -> Column:
            base = sum((F.lit(int(s)) * e[n] for i, (n, s) in enumerate(zip(SLIDERS, sliders)) if i != moved), F.lit(0))
            return F.struct(e[SLIDERS[moved]].alias("slope"), base.cast("bigint").alias("base"),
                            e["platform"].alias("platform"), F.lit(0).cast("bigint").alias("start"))

        others = sum(s for i, s in enumerate(sliders) if i != moved)
        won = _envelope(F.transform("entries", line), highest) if others else alone(SLIDERS[moved])
        return F.struct(F.lit(SLIDERS[moved]).alias("slider"), won.alias("won"))

    each = packs.select(*PACK_KEY, F.inline(F.array(*[along(i) for i in range(len(SLIDERS))])))
    # A position at a time, with the ranges before and after it.
    at = each.select(*PACK_KEY, "slider", "won", F.posexplode("won").alias("i", "w"))
    before, after = F.get("won", F.col("i") - 1), F.get("won", F.col("i") + 1)
    return at.select(
        *PACK_KEY, "slider", F.col("i").alias("range_no"), F.col("w.platform").alias("winner"),
        F.col("w.start").alias("from_setting"), F.coalesce(after["start"] - 1, F.lit(highest)).cast("bigint").alias("to_setting"),
        ((before["base"] - F.col("w.base")) / F.nullif(F.col("w.slope") - before["slope"], F.lit(0))).alias("meets_at"))
