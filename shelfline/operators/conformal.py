"""Intervals around predictions, from the errors of rows that the model was not fitted on (split conformal).

The bounds of a group are order statistics of its errors, at ranks that count the row to come as one more: if errors of
later rows come from where these came from, at least ``1 - miss`` of them lie between the bounds.  A group with too few
errors for such ranks takes those of the next coarser level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.joins import null_safe_join
from shelfline.functions.percentiles import exact_percentiles

MISS = 0.1


def least_rows(miss: float = MISS) -> int:
    """Errors that a group needs for bounds of its own."""
    n = 1
    while int((n + 1) * miss / 2 + 1e-9) < 1:
        n += 1
    return n


def _place(fraction: Column, n: Column) -> Column:
    """Place from 0: outwards from the fraction of ``n + 1``."""
    rank = fraction * (n + 1)
    outward = F.when(fraction < 0.5, F.floor(rank + F.lit(1e-9))).otherwise(F.ceil(rank - F.lit(1e-9)))
    return F.least(F.greatest(outward - 1, F.lit(0)), n - 1).cast("double")


def error_bounds(errors: DataFrame, levels: dict[str, tuple[str, ...]], by: tuple[str, ...] = (), error: str = "error",
                 miss: float = MISS) -> DataFrame:
    """``low`` and ``high`` per level and group.  ``levels``: name -> columns, the finest first; columns of other levels
    are null.  Groups that are too small are left out.  Null values of a column are a group."""
    grain = list(dict.fromkeys(c for columns in levels.values() for c in columns))
    options = F.explode(F.array(*[
        F.struct(F.lit(name).alias("level"), *[(F.col(c) if c in columns else F.lit(None).cast(errors.schema[c].dataType)).alias(c)
                                               for c in grain]) for name, columns in levels.items()]))
    rows = errors.filter(F.col(error).isNotNull()).select(*by, error, options.alias("_l")).select(*by, error, "_l.*")
    keys = [*by, "level", *grain]
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_rows(miss))
    found = exact_percentiles(rows, keys, error, {"low": miss / 2, "high": 1 - miss / 2}, place=_place)
    return null_safe_join(large, found, keys)


def with_bounds(rows: DataFrame, bounds: DataFrame, levels: dict[str, tuple[str, ...]], by: tuple[str, ...] = (),
                predicted: str = "predicted") -> DataFrame:
    """``confidence_lower``, ``confidence_upper`` (demand, so not below 0) and ``interval_level``, the level that gave
    them; nulls where no level had enough errors."""
    columns = rows.columns
    for name, group in levels.items():
        one = bounds.filter(F.col("level") == name).select(
            *by, *group, F.struct("low", "high", "level").alias(f"_{name}"))
        if by or group:
            rows = null_safe_join(rows, one, (*by, *group), "left")
        else:  # one row or none: a value, not a join without keys
            rows = rows.withColumn(f"_{name}", one.agg(F.max(f"_{name}").alias("_one")).scalar())
    chosen = F.coalesce(*[F.col(f"_{name}") for name in levels])
    return rows.select(*columns, F.greatest(F.lit(0.0), F.col(predicted) + chosen["low"]).alias("_low"), chosen.alias("_chosen")).select(
        *columns, F.when(F.col("_chosen").isNotNull(), F.col("_low")).alias("confidence_lower"),
        F.greatest(F.lit(0.0), F.col(predicted) + F.col("_chosen.high")).alias("_high"), F.col("_chosen.level").alias("interval_level")).select(
        *columns, "confidence_lower", F.when(F.col("interval_level").isNotNull(), F.col("_high")).alias("confidence_upper"), "interval_level")


def coverage(rows: DataFrame, actual: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of rows with an actual value and bounds whose value lies between them."""
    known = rows.filter(F.col(actual).isNotNull() & F.col("confidence_lower").isNotNull())
    inside = F.col(actual).between(F.col("confidence_lower"), F.col("confidence_upper"))
    return known.groupBy(*by).agg(F.avg(inside.cast("int")).alias("coverage"), F.count(F.lit(1)).alias("n"))
