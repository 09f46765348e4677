"""What the operators of this subpackage share: inputs, stored tables, spread joins, components."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import new_folder

# ASCII white space, as the contracts define words; plain and as a Java class.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
# Rows that one Arrow batch may carry to Python.  Texts are up to megabytes long, so far fewer than the default.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small, so a Python worker holds few long texts at a time."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, without lineage that a lost
    executor would repeat, and of a size that the planner knows."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: Column | str = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], spread: str | list[str], salts: int = 8,
                how: str = "left") -> DataFrame:
    """``rows`` joined to one row per group, each group offered ``salts`` times, so that the rows of a
    hot group meet it in ``salts`` places.  Null keys match null keys."""
    spread = [spread] if isinstance(spread, str) else spread
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    names = {k: f"_right_{k}" for k in keys}
    right = groups.withColumnsRenamed(names).withColumn(
        "_right_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    condition = F.col("_salt") == F.col("_right_salt")
    for k, r in names.items():
        condition = condition & F.col(k).eqNullSafe(F.col(r))
    return left.join(right, condition, how).drop("_salt", "_right_salt", *names.values())


# Rows of a side that is broadcast on purpose; rows of ids and digests have under 100 bytes.
MOST_BROADCAST = 400_000


def if_small(df: DataFrame) -> DataFrame:
    """A stored table of ids, to be broadcast if counting shows it to be small; beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def with_plain_names(docs: DataFrame, known: Iterable[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)``, which keeps the columns of ``docs``, while those that it does not know have names of no meaning:
    whatever a caller's column is called, it meets no column that ``work`` adds."""
    plain = docs.toDF(*[c if c in known else f"extra{i}" for i, c in enumerate(docs.columns)])
    return work(plain).toDF(*docs.columns)


def batches(names: list[str], columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, columns)],
                                      schema=schema)


@contextlib.contextmanager
def no_collector():
    """Switches the cycle collector off: the large dictionaries of a task hold no cycles, and walking them takes long."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def rows_of(iterator: Iterator[pa.RecordBatch], *names: str):
    """Per batch, one Python list per column."""
    for batch in iterator:
        yield [batch.column(n).to_pylist() for n in names]


def connected(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges`` (columns ``u`` and ``v``, longs): ``node``, ``component``, the
    smallest node that can be reached.

    Alternating large-star and small-star rounds.  Each round is written to the shared folder; the
    driver reads one row (number and checksum of the edges) per round.  Partial aggregation finds the
    smallest neighbour, so a hub with very many edges is no single task.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    pairs = stored(pairs, f"{label}-edges")
    before = None
    while True:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: every larger neighbour of u goes to the smallest node around u.
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: u and all its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        pairs = stored(small, f"{label}-edges")
        after = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if after == before:
            break
        before = after
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
