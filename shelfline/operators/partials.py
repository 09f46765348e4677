"""Aggregates as mergeable states: what a part of the rows contributes is stored, and states of parts are merged.

A state holds counts, sums, extremes and, for deviations, squares.  Sums and squares of values with the expected
decimals are whole numbers, so merging states in any order gives what one aggregate over all rows gives, to the
last bit.  A part with other values (more decimals, NaN, too large) has no whole sum; then the sums of
doubles, and mean and squared deviation merged pairwise, stand for it, and equal an aggregate over all rows up to rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numbers import MONEY, PERCENT, UNIT_PRICE, lossless


class Measure(NamedTuple):
    """``places``: decimals of a fractional column, None for whole numbers and flags."""

    column: str
    places: int | None = None
    extremes: bool = False
    spread: bool = False


class Summary(NamedTuple):
    """``keys``: name -> expression over the rows; ``columns``: name -> column over merged states."""

    keys: dict[str, str]
    measures: dict[str, Measure]
    columns: dict[str, Callable[[], Column]]


# -- of rows ------------------------------------------------------------------------------------

def state_columns(name: str, m: Measure) -> dict[str, Column]:
    c = F.col(m.column)
    out = {f"{name}_n": F.count(c)}
    if m.places is None:
        out[f"{name}_sum"] = F.sum(c.cast("bigint"))
    else:
        whole = lossless(c, m.places)
        out[f"{name}_sum"] = F.when(F.count(whole) == F.count(c), F.try_sum(whole))
        out[f"{name}_total"] = F.sum(c.cast("double"))
        if m.spread:
            square = F.try_multiply(whole, whole)
            out[f"{name}_squares"] = F.when(F.count(square) == F.count(c), F.try_sum(square))
            out[f"{name}_mean"] = F.avg(c.cast("double"))
            out[f"{name}_m2"] = F.var_pop(c.cast("double")) * F.count(c)
    if m.extremes:
        out[f"{name}_low"], out[f"{name}_high"] = F.min(c), F.max(c)
    return out


def states(summary: Summary, rows: DataFrame) -> DataFrame:
    """One state per group of ``rows``."""
    found = {"n_rows": F.count(F.lit(1))}
    for name, m in summary.measures.items():
        found |= state_columns(name, m)
    return rows.groupBy(*[F.expr(e).alias(k) for k, e in summary.keys.items()]).agg(*[c.alias(n) for n, c in found.items()])


# -- of states ----------------------------------------------------------------------------------

def _whole_sum(field: str, n: str) -> Column:
    """Null as soon as one part with values has no whole sum."""
    return F.when(F.count_if((F.col(n) > 0) & F.col(field).isNull()) == 0, F.try_sum(field))


def _deviation(name: str) -> Column:
    """Mean and squared deviation of parts, joined pair by pair in the order of their values."""
    part = F.struct(F.col(f"{name}_n").cast("double").alias("n"), F.col(f"{name}_mean").alias("mean"), F.col(f"{name}_m2").alias("m2"))
    parts = F.array_sort(F.collect_list(F.when(F.col(f"{name}_n") > 0, part)))

    def join(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.when(a["n"] == 0, b).otherwise(F.struct(
            n.alias("n"), (a["mean"] + apart * b["n"] / F.nullif(n, F.lit(0.0))).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / F.nullif(n, F.lit(0.0))).alias("m2")))

    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.reduce(parts, none, join)


def _merge(name: str, m: Measure) -> dict[str, Column]:
    n = f"{name}_n"
    out = {n: F.sum(n)}
    if m.places is None:
        out[f"{name}_sum"] = F.sum(f"{name}_sum")
    else:
        out |= {f"{name}_sum": _whole_sum(f"{name}_sum", n), f"{name}_total": F.sum(f"{name}_total")}
        if m.spread:
            both = _deviation(name)
            out |= {f"{name}_squares": _whole_sum(f"{name}_squares", n),
                    f"{name}_mean": both["mean"], f"{name}_m2": both["m2"]}
    if m.extremes:
        out |= {f"{name}_low": F.min(f"{name}_low"), f"{name}_high": F.max(f"{name}_high")}
    return out


def merged(summary: Summary, parts: DataFrame, keys: Iterable[str] | None = None, only: Iterable[str] | None = None) -> DataFrame:
    """One state per group of states; fewer ``keys`` roll them up, ``only`` some measures."""
    found = {"n_rows": F.sum("n_rows")}
    for name in only or summary.measures:
        found |= _merge(name, summary.measures[name])
    return parts.groupBy(*(keys or summary.keys)).agg(*[c.alias(n) for n, c in found.items()])


def finished(summary: Summary, state: DataFrame) -> DataFrame:
    """The aggregate table that merged states stand for."""
    return state.select(*summary.keys, *[c().alias(n) for n, c in summary.columns.items()])


def table(summary: Summary, rows: DataFrame) -> DataFrame:
    return finished(summary, states(summary, rows))


# -- columns of a finished table ------------------------------------------------------------------

def mean(name: str, places: int | None = None) -> Column:
    exact = F.try_divide(f"{name}_sum", f"{name}_n")
    if places is None:
        return exact
    return F.coalesce(exact / F.lit(float(10 ** places)), F.try_divide(f"{name}_total", f"{name}_n"))


def total(name: str, places: int | None = None) -> Column:
    if places is None:
        return F.col(f"{name}_sum")
    return F.coalesce(F.col(f"{name}_sum") / F.lit(float(10 ** places)), F.col(f"{name}_total"))


def deviation(name: str, places: int) -> Column:
    """Standard deviation of a sample; null below two values."""
    n, whole, squares = (F.col(f"{name}_{f}").cast("decimal(19,0)") for f in ("n", "sum", "squares"))
    pairs = F.col(f"{name}_n").cast("double") * (F.col(f"{name}_n") - 1)
    # n * squares - sum * sum, a whole number: 0 exactly where all values are equal.
    exact = (n * squares - whole * whole).cast("double") / pairs / F.lit(float(10 ** (2 * places)))
    other = F.col(f"{name}_m2") / (F.col(f"{name}_n") - 1)
    return F.when(F.col(f"{name}_n") > 1, F.sqrt(F.coalesce(exact, other)))


def low(name: str) -> Column:
    return F.col(f"{name}_low")


def high(name: str) -> Column:
    return F.col(f"{name}_high")


def _n_rows() -> Column:
    return F.col("n_rows")


def _keys(*names: str, **named: str) -> dict[str, str]:
    """``date`` is the day of the snapshot."""
    return {**{n: "to_date(snapshot_time)" if n == "date" else n for n in names}, **named}


PRICES = Summary(
    _keys("product_name", "category", "platform", "date", hour="hour_of_day", pack_size="pack_size", pack_unit="pack_unit"),
    {"price": Measure("effective_price", MONEY, extremes=True, spread=True), "unit": Measure("price_per_unit", UNIT_PRICE),
     "discount": Measure("discount_pct", PERCENT)},
    {"avg_price": lambda: mean("price", MONEY), "min_price": lambda: low("price"), "max_price": lambda: high("price"),
     "avg_price_per_unit": lambda: mean("unit", UNIT_PRICE), "avg_discount_pct": lambda: mean("discount", PERCENT),
     "price_stddev": lambda: deviation("price", MONEY), "record_count": _n_rows})
DELIVERY = Summary(
    _keys("platform", "date", "hour_of_day", "is_weekend", "weather", "is_raining"),
    {"minutes": Measure("delivery_minutes", extremes=True)},
    {"avg_delivery_mins": lambda: mean("minutes"), "min_delivery_mins": lambda: low("minutes"),
     "max_delivery_mins": lambda: high("minutes"), "record_count": _n_rows})
REVENUE = Summary(
    _keys("product_name", "category", "platform", "date", "pack_size"),
    {"revenue": Measure("revenue_inr", MONEY), "units": Measure("units_ordered")},
    {"total_revenue": lambda: total("revenue", MONEY), "total_units_ordered": lambda: total("units"),
     "avg_units_ordered": lambda: mean("units"), "record_count": _n_rows})
STOCK = Summary(
    _keys("product_name", "category", "platform", "date", "hour_of_day", "is_peak_hour"),
    {"stocked": Measure("in_stock"), "stock": Measure("stock_remaining")},
    {"availability_rate": lambda: mean("stocked"),
     "stockout_count": lambda: F.col("stocked_n") - F.coalesce(total("stocked"), F.lit(0)),
     "avg_stock_remaining": lambda: mean("stock"), "record_count": _n_rows})
DEMAND = Summary(
    _keys("product_name", "category", "platform", "date", "month"),
    {"units": Measure("units_ordered"), "price": Measure("effective_price", MONEY)},
    {"daily_demand": lambda: total("units"), "daily_avg_price": lambda: mean("price", MONEY)})
SUMMARIES = {"price_analytics": PRICES, "delivery_analytics": DELIVERY, "revenue_analytics": REVENUE,
             "stock_analytics": STOCK, "daily_demand": DEMAND}
