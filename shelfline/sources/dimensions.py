"""Small dimension tables.

Their size is fixed by :mod:`shelfline.fixed_values` or by the caller's own constants (months,
listed products), never by the data, so joins may broadcast them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfline import fixed_values as fv


def _table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    return spark.createDataFrame(pa.table(columns))


def weather_table(spark: SparkSession, rows=fv.WEATHER_BY_MONTH) -> DataFrame:
    month, label, rain, delay = zip(*rows)
    return _table(spark, {"month": pa.array(month, pa.int32()), "weather": list(label),
                          "rain_probability": list(rain), "rain_delay": list(delay)})


def seasonal_table(spark: SparkSession, factors=fv.SEASONAL_FACTORS) -> DataFrame:
    rows = [(p, m + 1, f) for p, months in factors.items() for m, f in enumerate(months)]
    product, month, factor = zip(*rows)
    return _table(spark, {"product_name": list(product), "month": pa.array(month, pa.int32()),
                          "seasonal_factor": list(factor)})


def platform_names(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    return _table(spark, {"platform": list(names), "display_name": list(names.values())})
