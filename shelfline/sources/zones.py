"""Processed and curated tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import fixed_values as fv
from shelfline.session import new_folder

PARTITIONS = ("date", "platform")
PARTITION_TYPES = {"date": T.DateType(), "platform": T.StringType()}


def write_zone(df: DataFrame, path: str, partitions: tuple[str, ...] = PARTITIONS, rebuild: bool = False,
               rebalance: bool = True) -> None:
    """Overwrites the partitions that ``df`` holds; with ``rebuild`` the whole table, so that no
    partition stays that the rows no longer have.

    Rebalancing by the partition columns gives each folder few files; unlike a repartition it
    lets adaptive execution cut a folder with very many rows into several tasks.  Rows for few folders, or that come
    folder by folder, do without: then each task writes a file per folder that it has rows of."""
    out = df.withColumn("date", F.to_date("snapshot_time")) if "date" in partitions and "date" not in df.columns else df
    if partitions and rebalance:
        out = out.hint("rebalance", *partitions)
    writer = out.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static" if rebuild else "dynamic")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def read_zone(spark: SparkSession, path: str, types: dict[str, T.DataType] = PARTITION_TYPES) -> DataFrame:
    """Folder names are read as ``types`` says, not as what they look like: platform '007' stays text."""
    seen = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in seen.fields])
    return spark.read.schema(schema).parquet(path)


def recent(df: DataFrame, days: int, as_of=None) -> DataFrame:
    """Rows of a dated table's last ``days`` folders, and the one that ends at ``as_of`` (default:
    the newest).  The bound is a scalar subquery on the folder names, so older folders are not read."""
    if "date" not in df.columns:
        return df
    end = df.agg(F.max("date")).scalar() if as_of is None else F.to_date(as_of)
    return df.filter((F.col("date") >= F.date_sub(end, days)) & (F.col("date") <= end))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For small results that several later steps use: computed once, no lineage to repeat when an
    executor is lost, and of a size that the planner knows, so that it broadcasts them in joins
    only if they are below its limit."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact(spark: SparkSession, source: str, target: str, order: tuple[str, ...] = ("snapshot_time", "record_id")) -> None:
    """Many small files -> few large ones, sorted so that time filters skip row groups.

    Without a partition number adaptive execution merges small ranges up to its advisory size;
    the id in the order splits instants that have very many rows."""
    rows = spark.read.parquet(source)
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(target)


def file_count(spark: SparkSession, path: str):
    files = spark.read.parquet(path).select(F.input_file_name().alias("file")).distinct()
    return files.agg(F.count(F.lit(1))).scalar()


def sample_rows(df: DataFrame, n: int = fv.SAMPLE_ROWS, key: str = "record_id") -> DataFrame:
    """The n rows with the smallest hash of the key: the same sample however rows are
    partitioned, found by a distributed top-k."""
    return df.orderBy(F.md5(key), key).limit(n)


def write_sample(df: DataFrame, path: str, n: int = fv.SAMPLE_ROWS) -> None:
    sample_rows(df, n).write.mode("overwrite").option("header", True).csv(path)


def retain(df: DataFrame, days: int, time: str = "snapshot_time") -> DataFrame:
    """Rows of the last ``days`` days, counted from the newest row's day."""
    newest = df.agg(F.to_date(F.max(time))).scalar()
    return df.filter(F.to_date(time) >= F.date_sub(newest, days))


def retention_zones(df: DataFrame, time: str = "snapshot_time", zones=fv.RETENTION_DAYS) -> DataFrame:
    """Rows that at least one zone keeps, with a flag per zone."""
    newest = df.agg(F.to_date(F.max(time))).scalar()
    kept = retain(df, max(zones.values()), time)
    return kept.withColumns({f"in_{zone}": F.to_date(time) >= F.date_sub(newest, days) for zone, days in zones.items()})
