"""Rolling windows over pre-aggregated series.

No window here runs over raw rows: each first reduces them to one row per day or hour, so a
partition has at most as many rows as the series has time steps, whatever the sales volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline import fixed_values as fv
from shelfline.functions.numbers import MONEY, exact_avg
from shelfline.operators.aggregate import daily_demand, day

SERIES = ("product_name", "platform")


def _rows(first: int, last: int):
    return Window.partitionBy(*SERIES).orderBy("date").rowsBetween(first, last)


def _days(first: int, last: int, series=SERIES):
    return Window.partitionBy(*series).orderBy("day_no").rangeBetween(first, last)


def with_day_number(df: DataFrame) -> DataFrame:
    return df.withColumn("day_no", F.unix_date("date"))


def rolling_demand(df: DataFrame) -> DataFrame:
    """Mean demand of the last seven rows of the series, and of the seven before."""
    return daily_demand(df).withColumns({
        "rolling_avg_7d": F.avg("daily_demand").over(_rows(-6, 0)),
        "rolling_avg_prev_7d": F.avg("daily_demand").over(_rows(-13, -7)),
    })


def rolling_demand_calendar(df: DataFrame) -> DataFrame:
    """As :func:`rolling_demand`, but over seven calendar days; days without sales are gaps."""
    out = with_day_number(daily_demand(df)).withColumns({
        "rolling_avg_7d": F.avg("daily_demand").over(_days(-6, 0)),
        "rolling_avg_prev_7d": F.avg("daily_demand").over(_days(-13, -7)),
    })
    return out.drop("day_no")


def label_trend(df: DataFrame, up: float = fv.TREND_UP, down: float = fv.TREND_DOWN) -> DataFrame:
    """'stable' also where there is no earlier average."""
    now, before = F.col("rolling_avg_7d"), F.col("rolling_avg_prev_7d")
    return df.withColumn("trend_label", F.when(now > before * F.lit(up), "trending")
                         .when(now < before * F.lit(down), "declining").otherwise("stable"))


def trend_labels(df: DataFrame) -> DataFrame:
    """Labelled days that have both averages."""
    return label_trend(rolling_demand(df)).filter(
        "rolling_avg_7d is not null and rolling_avg_prev_7d is not null")


def label_distribution(labels: DataFrame) -> DataFrame:
    return labels.groupBy("trend_label").agg(F.count(F.lit(1)).alias("n"))


def latest_trends(labels: DataFrame) -> DataFrame:
    """Each series' last labelled day, with its growth against the week before."""
    fields = ("date", "category", "trend_label", "rolling_avg_7d", "rolling_avg_prev_7d")
    last = labels.groupBy(*SERIES).agg(F.max_by(F.struct(*fields), "date").alias("s")).select(*SERIES, "s.*")
    return last.withColumn("growth", F.try_divide(F.col("rolling_avg_7d"), F.col("rolling_avg_prev_7d")))


def top_trending(labels: DataFrame, n: int = 5) -> DataFrame:
    """The n fastest growing series overall: a distributed top-k, no global window."""
    rows = latest_trends(labels).filter("trend_label = 'trending'")
    return rows.orderBy(F.desc("growth"), *SERIES).limit(n).select(
        *SERIES, "category", "date", "growth")


def ranked_trending(last: DataFrame, n: int = 10) -> DataFrame:
    """The n fastest growing series of each category, of those whose last label is trending."""
    order = Window.partitionBy("category").orderBy(F.desc("growth"), *SERIES)
    return last.filter("trend_label = 'trending'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(
        "category", "rank", *SERIES, "date", "growth")


def top_trending_by_category(labels: DataFrame, n: int = 10) -> DataFrame:
    return ranked_trending(latest_trends(labels), n)


def price_volatility(df: DataFrame, days: int = 7) -> DataFrame:
    """Standard deviation over mean of the daily average price, over calendar days."""
    daily = df.groupBy(*SERIES, day()).agg(exact_avg("effective_price", MONEY).alias("avg_price"))
    frame = _days(-(days - 1), 0)
    out = with_day_number(daily).withColumn(
        "volatility", F.try_divide(F.stddev_samp("avg_price").over(frame), F.avg("avg_price").over(frame)))
    return out.drop("day_no")


def availability_24h(df: DataFrame) -> DataFrame:
    """Availability over the 24 hours that end with each observed hour."""
    hour = F.date_trunc("hour", "snapshot_time")
    cells = df.groupBy(*SERIES, hour.alias("hour")).agg(
        F.count_if("in_stock").alias("stocked"), F.count("in_stock").alias("n"))
    frame = Window.partitionBy(*SERIES).orderBy("hour_no").rangeBetween(-23, 0)
    rate = F.sum("stocked").over(frame) / F.sum("n").over(frame)
    return (cells.withColumn("hour_no", (F.unix_timestamp("hour") / 3600).cast("bigint"))
            .select(*SERIES, "hour", rate.alias("availability_24h")))


def latest_time(df: DataFrame):
    """Newest snapshot as a scalar subquery: no collect, no join."""
    return df.agg(F.max("snapshot_time")).scalar()


def availability_7d(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Availability by product and platform over the last days up to ``as_of``."""
    end = latest_time(df) if as_of is None else as_of
    recent = df.filter((F.col("snapshot_time") > end - F.make_dt_interval(F.lit(days)))
                       & (F.col("snapshot_time") <= end))
    return recent.groupBy(*SERIES).agg(
        F.avg(F.col("in_stock").cast("int")).alias("availability_rate_7d"))


def price_history(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Daily average price of each product and platform over the last days up to ``as_of``."""
    end = latest_time(df) if as_of is None else as_of
    recent = df.filter((F.col("snapshot_time") > end - F.make_dt_interval(F.lit(days)))
                       & (F.col("snapshot_time") <= end))
    return recent.groupBy(*SERIES, day()).agg(
        exact_avg("effective_price", MONEY).alias("avg_price"),
        F.count(F.lit(1)).alias("record_count"))
