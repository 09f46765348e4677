"""Rounding and sums that do not depend on the order of rows.

Money, unit prices and ratings mostly have a known number of decimals.  Where all values of a group
do, they are summed as scaled integers, so the result is the same however the rows are partitioned.
A group with any other value (more decimals, NaN, infinite, too large) is summed as it is stored:
nothing is cut, and NaN stays within its group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY, UNIT_PRICE, RATING, PERCENT = 2, 4, 1, 2


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, places: int) -> Column:
    scale = F.lit(float(10 ** places))
    return F.floor(col(c) * scale + F.lit(0.5)) / scale


def scaled(c: Column | str, places: int) -> Column:
    return F.rint(col(c) * F.lit(float(10 ** places))).cast("bigint")


def lossless(c: Column | str, places: int) -> Column:
    """The scaled integer if it stands for exactly this value, else null."""
    scale = F.lit(float(10 ** places))
    whole = F.rint(col(c) * scale).try_cast("bigint")
    return F.when(whole / scale == col(c), whole)


def exact_sum(c: Column | str, places: int) -> Column:
    whole = lossless(c, places)
    exact = F.when(F.count(whole) == F.count(col(c)), F.try_sum(whole) / F.lit(float(10 ** places)))
    return F.coalesce(exact, F.sum(col(c).cast("double")))


def scaled_sum(c: Column | str, places: int) -> Column:
    """``exact_sum`` times its scale, as a whole double where all values have at most ``places`` decimals:
    sums of such sums are order-independent too."""
    whole = lossless(c, places)
    exact = F.when(F.count(whole) == F.count(col(c)), F.try_sum(whole)).cast("double")
    return F.coalesce(exact, F.sum(col(c).cast("double")) * F.lit(float(10 ** places)))


def exact_avg(c: Column | str, places: int) -> Column:
    whole = lossless(c, places)
    exact = F.when(F.count(whole) == F.count(col(c)),
                   F.try_divide(F.try_sum(whole), F.count(col(c))) / F.lit(float(10 ** places)))
    return F.coalesce(exact, F.avg(col(c).cast("double")))


def share(condition: Column) -> Column:
    """Share of rows for which the condition holds; rows where it is null do not count."""
    return F.sum(condition.cast("int")) / F.count(condition)
