"""Demand at future horizons, a checkable baseline forecast, and forecast quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline import fixed_values as fv
from shelfline.functions.joins import null_safe_join
from shelfline.functions.percentiles import exact_percentiles
from shelfline.operators.aggregate import day

GRAIN = ("category", "platform")
HORIZONS = {"24h": 1, "72h": 3}
BASELINE_VERSION = "baseline_v1"


def demand_series(df: DataFrame, grain=GRAIN) -> DataFrame:
    return df.groupBy(*grain, day()).agg(F.sum("units_ordered").alias("demand"))


def _at_offset(days: int, grain):
    """The value exactly ``days`` away in the same series, null if that day has no row.  A range
    frame of one day does this in the sort that the series needs anyway; no self-join."""
    frame = Window.partitionBy(*grain).orderBy("day_no").rangeBetween(days, days)
    return F.max("demand").over(frame)


def horizon_features(series: DataFrame, grain=GRAIN) -> DataFrame:
    """Targets: demand one and three days later."""
    rows = series.withColumn("day_no", F.unix_date("date"))
    return rows.withColumns({f"demand_in_{h}": _at_offset(d, grain) for h, d in HORIZONS.items()}).drop("day_no")


def naive_forecast(series: DataFrame, grain=GRAIN) -> DataFrame:
    """Forecast of a day = demand one (three) days before."""
    rows = series.withColumn("day_no", F.unix_date("date"))
    return rows.withColumns({f"naive_{h}": _at_offset(-d, grain) for h, d in HORIZONS.items()}).drop("day_no")


def forecast_overlay(series: DataFrame, horizon_days: int = 1, grain=GRAIN) -> DataFrame:
    """Actual and predicted demand on one time line, with days that have only one of them."""
    predicted = series.select(*grain, F.date_add("date", horizon_days).alias("date"),
                              F.col("demand").alias("predicted"))
    actual = series.withColumnRenamed("demand", "actual")
    return null_safe_join(actual, predicted, [*grain, "date"], "full").select(*grain, "date", "actual", "predicted")


def forecast_interval(series: DataFrame, grain=GRAIN) -> DataFrame:
    """Baseline forecast with the 5th and 95th percentile of its errors in the series."""
    rows = naive_forecast(series, grain).filter("naive_24h is not null")
    rows = rows.withColumn("error", F.col("demand") - F.col("naive_24h"))
    spread = exact_percentiles(rows, list(grain), "error", {"low": 0.05, "high": 0.95})
    return null_safe_join(rows, spread, grain).select(
        *grain, "date", "demand", F.col("naive_24h").alias("predicted"),
        (F.col("naive_24h") + F.col("low")).alias("confidence_lower"),
        (F.col("naive_24h") + F.col("high")).alias("confidence_upper"))


def horizon_table(series: DataFrame, grain=GRAIN) -> DataFrame:
    """Inputs and targets of a model that looks ahead: weekday, month, past demand, later demand.
    Where the day one or three days ago is missing, the mean of the week stands for it."""
    rows = naive_forecast(horizon_features(series, grain), grain)
    week = Window.partitionBy(*grain).orderBy(F.unix_date("date")).rangeBetween(-6, 0)
    rows = rows.withColumns({"day_of_week": F.dayofweek("date"), "month": F.month("date"),
                             "week_avg": F.avg("demand").over(week)})
    return rows.withColumns({f"naive_{h}": F.coalesce(f"naive_{h}", "week_avg") for h in HORIZONS})


def baseline_errors(rolling: DataFrame, by=("category", "platform")) -> DataFrame:
    """5th and 95th percentile of demand minus the mean of the seven rows before, per group."""
    before = Window.partitionBy("product_name", "platform").orderBy("date").rowsBetween(-7, -1)
    errors = rolling.withColumn("error", F.col("daily_demand") - F.avg("daily_demand").over(before))
    return exact_percentiles(errors, list(by), "error", {"low": 0.05, "high": 0.95})


def forecast_records(trends: DataFrame, errors: DataFrame, risk: DataFrame, generated_at,
                     horizon_hours: int = fv.FORECAST_HORIZON_HOURS) -> DataFrame:
    """One record per product and platform: expected daily demand with its interval, trend and
    stockout risk.  ``trends`` has the last labelled day of each series."""
    rows = null_safe_join(trends, errors, ["category", "platform"], "left")
    rows = null_safe_join(rows, risk.select("product_name", "platform", "stockout_risk"), ["product_name", "platform"], "left")
    demand = F.col("rolling_avg_7d")
    return rows.select(
        "product_name", "platform", generated_at.alias("forecast_generated_at"),
        F.lit(horizon_hours).alias("forecast_horizon_hours"), demand.alias("predicted_demand_index"),
        F.greatest(F.lit(0.0), demand + F.col("low")).alias("confidence_lower"),
        (demand + F.col("high")).alias("confidence_upper"), "trend_label", "stockout_risk",
        F.lit(BASELINE_VERSION).alias("model_version"))


def long_predictions(rows: DataFrame, horizons=HORIZONS) -> DataFrame:
    """One row per row and horizon: ``horizon``, ``predicted``, ``actual`` (null while it lies ahead)."""
    options = F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.lit(24 * d).alias("forecast_horizon_hours"), F.col(f"predicted_{h}").alias("predicted"),
                 F.col(f"demand_in_{h}").cast("double").alias("actual")) for h, d in horizons.items()]))
    wide = [c for c in rows.columns if not c.startswith(("predicted_", "demand_in_", "naive_"))]
    return rows.select(*wide, options.alias("_h")).select(*wide, "_h.*")


def model_records(predictions: DataFrame, trends: DataFrame, risk: DataFrame, generated_at, location: str, version: str,
                  grain=("product_name", "category", "platform")) -> DataFrame:
    """One record per series and horizon, as of the series' last day: predicted demand with its interval, trend and stockout risk.

    ``predictions`` has a row per series, day and horizon with its bounds; ``trends`` one ``trend_label`` per product, category
    and platform."""
    newest = predictions.groupBy(*grain, "horizon").agg(F.max("date").alias("date"))
    rows = null_safe_join(predictions, newest, (*grain, "horizon", "date"))
    rows = null_safe_join(rows, trends.select(*grain, "trend_label"), grain, "left")
    rows = null_safe_join(rows, risk.select("product_name", "platform", "stockout_risk"), ("product_name", "platform"), "left")
    return rows.select(
        *grain, F.lit(location).alias("location"), generated_at.alias("forecast_generated_at"), "date", "forecast_horizon_hours",
        F.col("predicted").alias("predicted_demand_index"), "confidence_lower", "confidence_upper", "interval_level", "trend_label",
        "stockout_risk", F.lit(version).alias("model_version"))


def forecast_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAPE over positive actuals in percent, RMSE and MAE, in one pass; null where undefined."""
    error = F.col(predicted) - F.col(actual)
    relative = F.when(F.col(actual) > 0, F.abs(error) / F.nullif(F.col(actual), F.lit(0)))
    return df.agg((F.avg(relative) * F.lit(100.0)).alias("mape"), F.sqrt(F.avg(error * error)).alias("rmse"),
                  F.avg(F.abs(error)).alias("mae"), F.count(error).alias("n"))


def time_split(df: DataFrame, train=fv.TRAIN_MONTHS, test=fv.TEST_MONTH):
    """Train and test rows by month; both filters reach the Parquet scan."""
    return df.filter(F.col("month").isin(*train)), df.filter(F.col("month") == test)


def time_split_counts(df: DataFrame, train=fv.TRAIN_MONTHS, test=fv.TEST_MONTH) -> DataFrame:
    part = F.when(F.col("month").isin(*train), "train").otherwise("test")
    return df.filter(F.col("month").isin(*train, test)).groupBy(part.alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("units_ordered").alias("units"))


def previous_label(labels: DataFrame, series=("product_name", "platform")) -> DataFrame:
    """Baseline classifier: the label of the series' row before."""
    order = Window.partitionBy(*series).orderBy("date")
    return labels.withColumn("predicted_label", F.lag("trend_label").over(order)).filter("predicted_label is not null")


def confusion(df: DataFrame, actual: str = "trend_label", predicted: str = "predicted_label") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_scores(matrix: DataFrame) -> DataFrame:
    """Accuracy and weighted F1 from the confusion counts (one row per pair of labels)."""
    sides = matrix.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("is_actual"), F.lit(0).cast("bigint").alias("is_pred"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("is_actual"), F.col("n").alias("is_pred"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("label").agg(F.sum("is_actual").alias("a"), F.sum("is_pred").alias("p"), F.sum("hit").alias("h"))
    f1 = F.coalesce(F.try_divide(2 * F.col("h"), F.col("a") + F.col("p")), F.lit(0.0))
    return per.agg((F.sum("h") / F.sum("a")).alias("accuracy"),
                   (F.sum(f1 * F.col("a")) / F.sum("a")).alias("weighted_f1"), F.sum("a").alias("n"))
