"""Current state of the market: latest listings, side by side, as-of prices, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline import fixed_values as fv
from shelfline.operators.trend import latest_time
from shelfline.schema import PACK_KEY

_CARRIED = ("record_id", "snapshot_time", "category", "effective_price", "price_per_unit", "in_stock",
            "stock_remaining", "delivery_minutes", "rating")


def latest_snapshot(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Newest row per pack and platform, at or before ``as_of``.  ``max_by`` keeps one candidate
    per key and task before the shuffle, unlike a row number over all rows."""
    rows = df if as_of is None else df.filter(F.col("snapshot_time") <= as_of)
    newest = F.max_by(F.struct(*_CARRIED), F.struct("snapshot_time", "record_id"))
    return rows.groupBy(*PACK_KEY, "platform").agg(newest.alias("s")).select(*PACK_KEY, "platform", "s.*")


def fastest_now(latest: DataFrame) -> DataFrame:
    """Shortest current delivery time of each platform, and whether it is the shortest of all."""
    per = latest.groupBy("platform").agg(F.min("delivery_minutes").alias("min_delivery_mins"))
    winner = per.agg(F.min(F.struct("min_delivery_mins", "platform")).alias("w")).select("w.platform").scalar()
    return per.withColumn("is_fastest", F.col("platform") == winner)


def side_by_side(latest: DataFrame, platforms: tuple[str, ...]) -> DataFrame:
    """One row per pack, the platforms' price and delivery time in columns."""
    wide = latest.filter(F.col("platform").isin(*platforms)).groupBy(*PACK_KEY)
    return wide.agg(*[
        F.max(F.when(F.col("platform") == p, F.col(c))).alias(f"{p}_{short}")
        for p in platforms for c, short in (("effective_price", "price"), ("delivery_minutes", "mins"))])


def cheapest(latest: DataFrame) -> DataFrame:
    """Cheapest platform per pack, by total and by unit price; ties go to the first name."""
    return latest.groupBy(*PACK_KEY).agg(
        F.min(F.struct("effective_price", "platform")).alias("p"),
        F.min(F.struct("price_per_unit", "platform")).alias("u"),
    ).select(*PACK_KEY, F.col("p.platform").alias("cheapest_platform"),
             F.col("p.effective_price").alias("price"),
             F.col("u.platform").alias("cheapest_unit_platform"),
             F.col("u.price_per_unit").alias("unit_price"))


def single_platform_products(df: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Packs that only one platform listed during the last days."""
    end = latest_time(df) if as_of is None else as_of
    recent = df.filter((F.col("snapshot_time") > end - F.make_dt_interval(F.lit(days)))
                       & (F.col("snapshot_time") <= end))
    return recent.groupBy(*PACK_KEY).agg(
        F.min("platform").alias("platform"), F.max("platform").alias("_other"),
        F.count(F.lit(1)).alias("record_count"),
    ).filter("platform = _other").drop("_other")


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
               values: list[str], slot: str = "hour") -> DataFrame:
    """Attach to each left row the values of the latest right row strictly before it.

    Left and right rows meet in one window per (keys, time slot), so a hot key is split over its
    slots.  What a slot inherits from earlier ones is found on one row per key and slot, and
    enters the window as an extra right row.  Right rows at the same instant are ordered by values.
    """
    keys_of = [F.col(k) for k in keys]
    at = F.struct(F.col(right_time).alias("t"), *[F.col(v) for v in values])
    reference = right.select(*keys_of, F.col(right_time).alias("_t"), F.lit(1).alias("_kind"),
                             F.date_trunc(slot, right_time).alias("_slot"), at.alias("_ref"))
    rows = left.select(*keys_of, F.col(left_time).alias("_t"), F.lit(0).alias("_kind"),
                       F.date_trunc(slot, left_time).alias("_slot"),
                       F.struct(*[F.col(c) for c in left.columns if c not in keys]).alias("_row"))

    last_in_slot = reference.groupBy(*keys, "_slot").agg(F.max("_ref").alias("_last"))
    wanted = rows.select(*keys, "_slot").distinct()
    ends = last_in_slot.unionByName(wanted, allowMissingColumns=True)
    slots = ends.groupBy(*keys, "_slot").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (slots.withColumn("_ref", F.last("_last", ignorenulls=True).over(before))
               .filter("_ref is not null")
               .select(*keys, F.col("_slot").alias("_t"), F.lit(-1).alias("_kind"), "_slot", "_ref"))

    both = reference.unionByName(carried).unionByName(rows, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_slot").orderBy("_t", "_kind", "_ref")
    # Kind -1 (inherited) sorts before, and kind 1 (same instant) after, a left row.
    seen = order.rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumn("_hit", F.last("_ref", ignorenulls=True).over(seen)).filter("_kind = 0")
    names = [c for c in left.columns if c not in keys]
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in names],
                      F.col("_hit.t").alias("ref_time"),
                      *[F.col(f"_hit.{v}").alias(f"ref_{v}") for v in values])


def as_of_join_each(rows: DataFrame, keys: list[str], by: str, members: tuple[str, ...], time: str, values: dict[str, str],
                    slot: str = "day") -> DataFrame:
    """Every row against the latest row strictly before it of each of ``members`` (values of column ``by``), its own included:
    one result row per row and member, with ``ref_<by>``, ``ref_time`` and ``ref_<name>`` for ``values``: name -> column.

    As in :func:`as_of_join` rows meet in one window per (keys, time slot), and at one instant the largest values count.  But
    a row enters once, being asked and looked up at the same time: it finds all members in one pass, and is repeated per
    member after that.  The slots' ends come from the same shuffle; there is one row per key and slot of them, which is why slots are longer."""
    cell = F.struct(*keys, F.date_trunc(slot, time).alias("_slot"))
    others = [c for c in rows.columns if c not in keys]
    # A struct of the keys is never null, so rows with null keys meet in plain joins.
    laid = rows.select(cell.alias("_cell"), *others).repartition("_cell")
    at = F.struct(F.col(time).alias("t"), *[F.col(c).alias(v) for v, c in values.items()])
    seen = [F.max(F.when(F.col(by) == m, at)) for m in members]
    ends = laid.groupBy("_cell").agg(*[s.alias(f"_last{i}") for i, s in enumerate(seen)])
    before = Window.partitionBy(*[F.col("_cell")[k] for k in keys]).orderBy(F.col("_cell")["_slot"]).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_cell").alias("_c"), *[
        F.last(f"_last{i}", ignorenulls=True).over(before).alias(f"_first{i}") for i in range(len(members))])
    # Rows without a time come before all others.
    order = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(-(1 << 62)))
    earlier = Window.partitionBy("_cell").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    hits = laid.select("_cell", *others, *[s.over(earlier).alias(f"_hit{i}") for i, s in enumerate(seen)])
    out = hits.join(carried, F.col("_cell") == F.col("_c"))
    per_member = F.array(*[F.struct(F.lit(m).alias("member"), F.coalesce(f"_hit{i}", f"_first{i}").alias("hit")) for i, m in enumerate(members)])
    out = out.select("_cell", *others, F.explode(per_member).alias("_ref"))
    return out.select(*[F.col("_cell")[k].alias(k) for k in keys], F.col("_ref.member").alias(f"ref_{by}"), *others,
                      F.col("_ref.hit.t").alias("ref_time"), *[F.col(f"_ref.hit.{v}").alias(f"ref_{v}") for v in values])


def series_gaps(df: DataFrame, keys: list[str], platforms: tuple[str, ...], step_seconds: int = fv.SLOT_MINUTES * 60,
                time: str = "snapshot_time", first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Grid steps at which a series was not observed, as ranges of epoch steps.

    A series is every known key on every platform, seen there or not; the grid runs from ``first``
    to ``last``, by default over the observed steps.  Only observed steps and two end marks per
    series are sorted; the grid itself is never built, so the cost follows the data and not the
    number of empty cells.
    """
    def step(c):
        return F.floor(F.unix_timestamp(c) / step_seconds)

    seen = df.select(*keys, "platform", step(time).alias("step")).distinct()
    # The count keeps the optimiser from reading the rows again instead of the distinct steps, so
    # that one shuffle serves the bounds, the series and the steps.
    per_key = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("low"),
                                      F.max("step").alias("high")).filter("n > 0")
    lowest = per_key.agg(F.min("low")).scalar() if first is None else step(first)
    highest = per_key.agg(F.max("high")).scalar() if last is None else step(last)
    inside = seen if first is None and last is None else seen.filter(F.col("step").between(lowest, highest))
    series = per_key.select(*keys, F.explode(F.array(*map(F.lit, platforms))).alias("platform"))
    marks = series.withColumn("step", F.explode(F.array(lowest - 1, highest + 1)))
    order = Window.partitionBy(*keys, "platform").orderBy("step")
    gaps = inside.unionByName(marks).withColumn("next", F.lead("step").over(order)).filter("next > step + 1")
    return gaps.select(*keys, "platform", (F.col("step") + 1).alias("gap_first"),
                       (F.col("next") - 1).alias("gap_last"),
                       (F.col("next") - F.col("step") - 1).alias("missing"))


def pack_gaps(df: DataFrame, platforms: tuple[str, ...]) -> DataFrame:
    """Gaps of every pack on every platform, at the cadence of the feeds; the first and last missing slot as instants."""
    seconds = fv.SLOT_MINUTES * 60
    gaps = series_gaps(df, list(PACK_KEY), platforms, seconds)
    return gaps.select(*PACK_KEY, "platform", F.timestamp_seconds(F.col("gap_first") * seconds).alias("gap_first"),
                       F.timestamp_seconds(F.col("gap_last") * seconds).alias("gap_last"), "missing")
