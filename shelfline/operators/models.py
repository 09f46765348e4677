"""Demand regressor and trend classifier (MLlib)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from shelfline import fixed_values as fv
from shelfline.operators.forecast import GRAIN, HORIZONS, time_split
from shelfline.session import ensure_checkpoint_dir, new_folder

INDEXED = {"platform": "platform_idx", "category": "category_idx",
           "product_name": "product_idx", "weather": "weather_idx"}
HORIZON_FEATURES = ("day_of_week", "month", "demand", "naive_24h", "naive_72h", "week_avg")
# Bins of every feature, whatever the catalogue; ``maxBins`` of the fits overrides it.
MAX_BINS = 64
# Rows of the overall mean that a category value's own mean is mixed with.
PRIOR_ROWS = 10
# Parts of the training rows; a row is described by the means of the other parts.
FOLDS = 5
FOLD_KEYS = {"demand": ("record_id",), "trend": ("product_name", "platform", "date")}
_TYPES = {
    "units_ordered": "int", "effective_price": "double", "mrp": "double", "price_per_unit": "double",
    "delivery_minutes": "int", "rating": "double", "discount_pct": "double", "seasonal_factor": "double",
    "bulk_discount_pct": "double", "festival_demand_mult": "double", "hour_of_day": "int", "month": "int",
    "pack_size": "int", "stock_remaining": "int",
}
_FLAGS = ("is_weekend", "is_peak_hour", "is_raining", "in_stock")


def ml_features(df: DataFrame) -> DataFrame:
    """Numeric types, flags as integers, weekday; rows lacking a critical value are dropped.

    A column that already has its type is not cast, so filters on it still reach the scan."""
    kinds = dict(df.dtypes)
    out = [F.col(c).cast(_TYPES[c]).alias(c) if kinds[c] != _TYPES.get(c, kinds[c]) else F.col(c) for c in df.columns]
    out += [F.col(c).cast("int").alias(f"{c}_int") for c in _FLAGS]
    out.append(F.dayofweek("snapshot_time").alias("day_of_week"))
    return not_null(df.select(*out), "units_ordered", "effective_price", "hour_of_day")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Drops rows with a null in any of the columns.  Plain conditions, unlike ``na.drop``, are
    pushed into the Parquet scan."""
    return df.filter(" and ".join(f"{c} is not null" for c in columns))


def indexer(columns: dict[str, str]) -> StringIndexer:
    """One pass over the data for all columns; unseen values keep an index of their own."""
    return StringIndexer(inputCols=list(columns), outputCols=list(columns.values()), handleInvalid="keep")


def assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def fold_of(key, folds: int = FOLDS) -> Column:
    """Part of a training row, by a hash of its key: the same however rows are partitioned."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


class MeanEncoder(Transformer, MLWritable, MLReadable):
    """Category values as the mean of the target among the training rows of that value, joined in.

    ``means`` has a row per column and value, in storage, so a catalogue of any size is fitted and none of
    it reaches the driver.  ``columns``: category column -> names of its means, one per target; values that
    training had not, nulls too, get the ``overall`` means.
    """

    def __init__(self, columns: dict[str, list[str]], overall: list[float], means: DataFrame):
        super().__init__()
        self.columns, self.overall, self.means = columns, overall, means

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._described(dataset, self.means)

    def _described(self, dataset: DataFrame, means: DataFrame, *also: str) -> DataFrame:
        for column, names in self.columns.items():
            right = means.filter(F.col("feature") == column).select(
                F.col("value").alias("_value"), *[F.col(c).alias(f"_{c}") for c in also],
                *[F.col(f"mean_{i}").alias(n) for i, n in enumerate(names)])
            on = F.col(column).eqNullSafe(F.col("_value"))
            for c in also:
                on = on & (F.col(c) == F.col(f"_{c}"))
            dataset = dataset.join(right, on, "left").drop("_value", *[f"_{c}" for c in also])
            dataset = dataset.withColumns({n: F.coalesce(n, F.lit(m)) for n, m in zip(names, self.overall)})
        return dataset

    def write(self) -> MLWriter:
        return _MeanWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _MeanReader()


def _means_schema(n: int) -> str:
    return ", ".join(["value string", *[f"mean_{i} double" for i in range(n)], "feature string"])


class _MeanWriter(MLWriter):
    def __init__(self, instance: MeanEncoder):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        known = {"columns": self.instance.columns, "overall": self.instance.overall}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=known)
        self.instance.means.write.partitionBy("feature").parquet(f"{path}/means")


class _MeanReader(MLReader):
    def load(self, path: str) -> MeanEncoder:
        known = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        means = self.sparkSession.read.schema(_means_schema(len(known["overall"]))).parquet(f"{path}/means")
        return MeanEncoder(known["columns"], known["overall"], means)


def category_cells(rows: DataFrame, columns, fold: Column, targets: list[Column]) -> DataFrame:
    """Rows and sums of the targets per column, value and fold: all that the means are made of, in one pass."""
    names = [f"sum_{i}" for i in range(len(targets))]
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]))
    rows = rows.select(values.alias("e"), fold.alias("fold"), *[t.cast("double").alias(n) for t, n in zip(targets, names)])
    return rows.groupBy("e.feature", "e.value", "fold").agg(F.count("sum_0").alias("n"), *[F.sum(n).alias(n) for n in names])


def means_of(cells: DataFrame, overall: list[float]) -> DataFrame:
    """Per column and value, over all folds; values of few rows are drawn to the overall means by ``PRIOR_ROWS``."""
    sums = [F.sum(f"sum_{i}") for i in range(len(overall))]
    return cells.groupBy("feature", "value").agg(*[_drawn(x, F.sum("n"), m).alias(f"mean_{i}") for i, (x, m) in enumerate(zip(sums, overall))])


def means_of_other_folds(cells: DataFrame, overall: list[float]) -> DataFrame:
    """Per column, value and fold, over the rows of the other folds.  A window over as many rows as there are folds."""
    value = Window.partitionBy("feature", "value")
    rest = [F.sum(f"sum_{i}").over(value) - F.coalesce(f"sum_{i}", F.lit(0.0)) for i in range(len(overall))]
    n = F.sum("n").over(value) - F.col("n")
    return cells.select("feature", "value", "fold", *[
        _drawn(x, n, m).alias(f"mean_{i}") for i, (x, m) in enumerate(zip(rest, overall))])


def _drawn(total: Column, n: Column, overall: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + F.lit(PRIOR_ROWS * overall)) / (n + PRIOR_ROWS)


def mean_encoder(train: DataFrame, columns: dict[str, str], targets: list[Column], key) -> tuple[MeanEncoder, DataFrame]:
    """The encoder, whose means are those of all rows, and ``train`` described by the means of the other folds: no
    row sees its own target.  Of several targets the means are numbered.  The driver reads the overall means only."""
    spark = train.sparkSession
    key = key if set(key) <= set(train.columns) else train.columns
    train = train.withColumn("_fold", fold_of(key))
    path = new_folder(spark, "category-cells")
    category_cells(train, columns, F.col("_fold"), targets).write.partitionBy("feature").parquet(path)
    schema = ", ".join(["value string, fold int, n long", *[f"sum_{i} double" for i in range(len(targets))], "feature string"])
    cells = spark.read.schema(schema).parquet(path)
    one = cells.filter(F.col("feature") == next(iter(columns)))  # every row is in one cell of each column
    overall = [m if m is not None else 0.0 for m in one.agg(*[F.try_divide(F.sum(f"sum_{i}"), F.sum("n")) for i in range(len(targets))]).first()]
    stored = []
    for means, label, more in ((means_of(cells, overall), "category-means", ""), (means_of_other_folds(cells, overall), "fold-means", "_fold int, ")):
        to = new_folder(spark, label)
        means.withColumnsRenamed({"fold": "_fold"}).write.partitionBy("feature").parquet(to)
        stored.append(spark.read.schema(more + _means_schema(len(targets))).parquet(to))
    named = {c: [out] if len(targets) == 1 else [f"{out}_{i}" for i in range(len(targets))] for c, out in columns.items()}
    encoder = MeanEncoder(named, overall, stored[0])
    return encoder, encoder._described(train, stored[1], "_fold").drop("_fold")


def _fit(train: DataFrame, columns: dict[str, str], features, estimator, key, labels: StringIndexer | None = None) -> PipelineModel:
    """``key``: columns that name a training row.  ``columns``: category column -> its name among the features.  ``labels`` turns a text label into classes;
    then a category value is described by its share of rows in each class."""
    ensure_checkpoint_dir(train.sparkSession)
    stages, ready, targets, after = [], train, [F.col(estimator.getLabelCol())], []
    if labels is not None:
        classes = labels.fit(train)
        stages, ready = [classes], classes.transform(train)
        targets = [(F.col(estimator.getLabelCol()) == i).cast("int") for i in range(len(classes.labels))]
        after = [IndexToString(inputCol="prediction", outputCol="predicted_label", labels=classes.labels)]
    encoder, described = mean_encoder(ready, columns, targets, key)
    means = dict(zip(columns.values(), encoder.columns.values()))
    vectors = assembler(n for f in features for n in means.get(f, [f]))
    ready = vectors.transform(described).select("features", estimator.getLabelCol())
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.setCheckpointInterval(10).fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([*stages, encoder, vectors, model, *after])


def fit_demand_model(train: DataFrame, **settings) -> PipelineModel:
    options = {"maxBins": MAX_BINS, **fv.DEMAND_MODEL, "seed": fv.SEED, **settings}
    gbt = GBTRegressor(featuresCol="features", labelCol="units_ordered", **options)
    return _fit(train, INDEXED, fv.DEMAND_FEATURES, gbt, FOLD_KEYS["demand"])


def fit_horizon_model(rows: DataFrame, horizon: str, grain=GRAIN, **settings) -> PipelineModel:
    """Regressor for the demand that :func:`forecast.horizon_table` has ``horizon`` ahead."""
    target = f"demand_in_{horizon}"
    options = {"maxBins": MAX_BINS, **fv.DEMAND_MODEL, "seed": fv.SEED, **settings}
    gbt = GBTRegressor(featuresCol="features", labelCol=target, predictionCol=f"predicted_{horizon}", **options)
    names = {c: f"{c}_idx" for c in grain}
    return _fit(rows.filter(F.col(target).isNotNull()), names, [*names.values(), *HORIZON_FEATURES], gbt, (*grain, "date"))


def predict_horizons(models: dict[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """``predicted_<horizon>`` by each model."""
    for model in models.values():
        known = rows.columns
        rows = model.transform(rows)
        rows = rows.select(*known, *[c for c in rows.columns if c.startswith("predicted_") and c not in known])
    return rows


def forecast_horizons(rows: DataFrame, **settings) -> DataFrame:
    """Demand one and three days ahead, by one model per horizon fitted on the training months."""
    train, _ = time_split(rows)
    return predict_horizons({h: fit_horizon_model(train, h, **settings) for h in HORIZONS}, rows)


def fit_trend_model(train: DataFrame, **settings) -> PipelineModel:
    options = {"maxBins": MAX_BINS, **fv.TREND_MODEL, "seed": fv.SEED, **settings}
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", **options)
    label = StringIndexer(inputCol="trend_label", outputCol="label", handleInvalid="keep")
    names = {"platform": "platform_idx", "category": "category_idx"}
    return _fit(train, names, fv.TREND_FEATURES, forest, FOLD_KEYS["trend"], label)


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def forecast_demand(model: PipelineModel, rows: DataFrame, location: str, train=fv.TRAIN_MONTHS) -> DataFrame:
    """Predictions for all rows; ``is_train`` marks those the model has seen."""
    return model.transform(rows).select(
        "record_id", "snapshot_time", "product_name", "category", "platform", "pack_size", "pack_unit",
        "units_ordered", "effective_price", "hour_of_day", "month", "is_weekend", "weather",
        F.col("prediction").alias("predicted_demand"), F.lit(location).alias("location"),
        F.lit(fv.FORECAST_HORIZON_HOURS).alias("forecast_horizon_hours"),
        F.lit(fv.DEMAND_MODEL_VERSION).alias("model_version"),
        F.col("month").isin(*train).alias("is_train"))


def classify_trends(model: PipelineModel, labels: DataFrame, location: str) -> DataFrame:
    return model.transform(labels).select(
        "product_name", "category", "platform", "date", "month", "daily_demand", "daily_avg_price",
        "rolling_avg_7d", "trend_label", F.col("prediction").alias("predicted_label_idx"),
        "predicted_label", F.lit(location).alias("location"))


def predicted_trends(model: PipelineModel, labels: DataFrame) -> DataFrame:
    """``labels`` with the predicted label as ``trend_label``, for rankings and records."""
    return model.transform(labels).select(*[F.col("predicted_label").alias(c) if c == "trend_label" else c for c in labels.columns])


def split_and_fit(rows: DataFrame, fit, **settings):
    """Model fitted on the training months, and its predictions for the test month."""
    train, test = time_split(rows)
    model = fit(train, **settings)
    return model, model.transform(test)


def index_features(rows: DataFrame) -> DataFrame:
    """Category indices and the assembled vector, without a model."""
    train, _ = time_split(rows)
    return Pipeline(stages=[indexer(INDEXED), assembler(fv.DEMAND_FEATURES)]).fit(train).transform(rows)
