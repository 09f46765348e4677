"""Column expressions of the listing domain.  No I/O, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.functions.numbers import col, round_half_up


def word_is(c: Column | str, word: str) -> Column:
    """True for the word, False for anything else and for null."""
    return F.coalesce(col(c) == F.lit(word), F.lit(False))


def first_int(c: Column | str) -> Column:
    """First run of digits as int, null when there is none ("15 mins" -> 15)."""
    return F.regexp_extract(col(c), r"(\d+)", 1).try_cast("int")


def parse_time(c: Column | str, fmt: str = fv.RAW_TIME_FORMAT) -> Column:
    return F.try_to_timestamp(col(c), F.lit(fmt))


def net_price(before: Column | str, discount_pct: Column | str) -> Column:
    return round_half_up(col(before) * (F.lit(1.0) - col(discount_pct) / F.lit(100.0)), 2)


def unit_price(price: Column | str, pack_size: Column | str) -> Column:
    return round_half_up(F.try_divide(col(price), col(pack_size).cast("double")), 4)


def sold_units(wanted: Column | str, demand_factor: Column | str, stock: Column | str) -> Column:
    """Ordered units, scaled by demand, truncated, and never more than the stock."""
    return F.least((col(wanted) * col(demand_factor)).cast("int"), col(stock).cast("int"))


def revenue(price: Column | str, units: Column | str) -> Column:
    return round_half_up(col(price) * col(units), 2)


def time_band(hour: Column | str, bands=fv.TIME_BANDS) -> Column:
    expr = F
    for first, last, factor in bands:
        expr = expr.when(col(hour).between(first, last), F.lit(factor))
    return expr.otherwise(F.lit(1.0))


def is_peak(hour: Column | str) -> Column:
    """Late night counts as peak: its factor is above the limit too."""
    return time_band(hour) > F.lit(fv.PEAK_ABOVE)


def is_weekend(when: Column | str) -> Column:
    return F.dayofweek(col(when)).isin(1, 7)


def bulk_factor(size: Column | str, base: Column | str, largest: Column | str) -> Column:
    span = F.greatest(col(largest) - col(base), F.lit(1))
    factor = F.lit(1.0) - F.lit(fv.BULK_STEP) * (col(size) - col(base)) / span
    return F.when(col(size) > col(base), F.greatest(F.lit(fv.BULK_FLOOR), factor)).otherwise(F.lit(1.0))


def weekend_premium(weekend: Column | str, category: Column | str, hour: Column | str,
                    categories=fv.WEEKEND_PREMIUM_CATEGORIES) -> Column:
    applies = col(weekend) & col(category).isin(*categories) & col(hour).between(*fv.WEEKEND_PREMIUM_HOURS)
    return F.when(applies, F.lit(fv.WEEKEND_PREMIUM)).otherwise(F.lit(1.0))


def adjusted_minutes(base: Column | str, hour: Column | str, weekend: Column | str,
                     raining: Column | str, rain_delay: Column | str) -> Column:
    minutes = (col(base) * time_band(hour)
               * F.when(col(weekend), F.lit(fv.WEEKEND_DELAY)).otherwise(F.lit(1.0))
               * F.when(col(raining), col(rain_delay)).otherwise(F.lit(1.0)))
    low, high = fv.DELIVERY_RANGE
    return F.greatest(F.lit(low), F.least(F.lit(high), minutes.cast("int")))
