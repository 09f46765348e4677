"""Exact percentiles of large groups.

The built-in exact percentile keeps all distinct values of a group in one buffer.  Here a sketch
gives, per group, two values that enclose the wanted rank; only distinct values between them are
sorted, and everything below is one count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ACCURACY = 10_000
SALTS = 32
MARGIN = 10 / ACCURACY  # ten times the sketch's rank error


def _interpolated(fraction: Column, n: Column) -> Column:
    return fraction * (n - 1)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float],
                      small_group: int = ACCURACY, place: Callable[[Column, Column], Column] = _interpolated) -> DataFrame:
    """One row per group, each named fraction as a column, linearly interpolated between ranks.  ``place`` gives the
    place from 0 of a fraction among ``n`` values; it may be a few ranks off the fraction, not more.

    Rows whose key is null are a group of their own.  Groups of up to ``small_group`` rows are sorted whole.  An enclosure that misses the rank
    raises an error; it never gives a wrong value.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    ends = [end for f in fractions.values() for end in (max(0.0, f - MARGIN), min(1.0, f + MARGIN))]
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, ACCURACY).alias("_q"))
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(f).alias("fraction"),
                 F.when(F.col("_n") > small_group, F.get("_q", F.lit(2 * i))).alias("low"),
                 F.when(F.col("_n") > small_group, F.get("_q", F.lit(2 * i + 1))).alias("high"))
        for i, (name, f) in enumerate(fractions.items())])
    # Every group is joined in parts, by a hash of the value; one group is never one task.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    theirs = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    ranges = sketch.select(*theirs, "_n", F.explode(wanted).alias("_w")).select("*", salts.alias("_part"))

    counts = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn(
        "_salt", F.pmod(F.hash("_v"), F.lit(SALTS)))
    below = F.col("_v") < F.col("_w.low")
    same = F.col("_salt") == F.col("_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    part = counts.join(ranges, same).filter(F.col("_w.high").isNull() | (F.col("_v") <= F.col("_w.high")))
    part = part.groupBy(*keys, "_n", "_w.name", "_w.fraction", F.when(~F.coalesce(below, F.lit(False)), F.col("_v"))
                        .alias("_v")).agg(F.sum("_c").alias("_c"))

    order = Window.partitionBy(*keys, "name").orderBy(F.col("_v").asc_nulls_first())
    part = part.withColumns({"_end": F.sum("_c").over(order), "_place": place(F.col("fraction"), F.col("_n"))})
    part = part.withColumn("_start", F.col("_end") - F.col("_c"))

    def at(rank):
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    picked = part.groupBy(*keys, "name", "_place").agg(
        at(F.floor("_place")).alias("_low"), at(F.ceil("_place")).alias("_high"))
    exact = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_place") - F.floor("_place"))
    checked = F.when(exact.isNull(), F.raise_error(F.lit("percentile rank outside its enclosure"))).otherwise(exact)
    picked = picked.withColumn("_p", checked)
    return picked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("name") == name, F.col("_p"))).alias(name) for name in fractions])
