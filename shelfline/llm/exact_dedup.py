"""Exact deduplication by an aggregate, its result kept as an extendible-hash index on shared files, in DataFrame operations only.

Texts are hashed.  A directory of ``2 ** depth`` entries, by leading bits of the hash, points to buckets; its depth
follows from the number of rows, and every entry points to the shallowest bucket that is not overfull, so
entries of sparse regions share one, and a full bucket is split by one more bit.  The index is
written with one folder per bucket.  The directory decides those folders' names and nothing else: it does not
double while it is filled, and no row is routed by it.  Which rows are equal is decided by an aggregate, shuffled by hash and
text: rows of one hash and one text, compared byte by byte as its key and combined before the shuffle, become one entry; different texts under one hash are a chain of entries.  So a group of copies
of any size is one short row before it moves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.common import SPACE_CLASS, if_small, spread_join, stored, whole_text, with_plain_names
from shelfline.session import new_folder

HASH_BITS = 64
# Rows that a bucket holds before it is split.
CAPACITY = 50_000
# Directory depth beyond the one that an even spread would need.
SPARE_BITS = 2


def normalised(text: Column | str = "text") -> Column:
    """Whole text, null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(whole_text(text), SPACE_CLASS + "+", " ")


def text_hash(text: Column, bits: int = HASH_BITS) -> Column:
    """The leading ``bits`` bits of the hash, as an unsigned number for fewer than 64 bits."""
    return F.xxhash64(text) if bits == 64 else F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def _prefix(value: Column, depth: Column | int, bits: int) -> Column:
    """Leading ``depth`` bits of a hash; depth 0 gives 0."""
    depth = depth if isinstance(depth, Column) else F.lit(depth)
    unsigned = F.shiftrightunsigned(value, 1) if bits == 64 else value  # 63 bits are plenty
    return F.floor(unsigned / F.pow(F.lit(2.0), F.lit(min(bits, 63)) - depth)).cast("long")


def directory(rows: DataFrame, bits: int = HASH_BITS, capacity: int = CAPACITY) -> tuple[int, DataFrame]:
    """Global depth, and per directory entry (``cell``) its bucket: ``bucket`` (prefix) and ``depth``.

    ``rows`` has ``hash``.  One entry per ``capacity / 2 ** SPARE_BITS`` rows or so; the driver reads one count.
    """
    total = rows.count()
    depth = min(max(0, math.ceil(math.log2(max(1, total) / capacity)) + SPARE_BITS), bits, 30)
    cells = rows.groupBy(_prefix(F.col("hash"), depth, bits).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("bucket", F.floor(F.col("cell") / F.pow(F.lit(2.0), F.lit(depth) - F.col("depth"))).cast("long"))
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("size"))
    # At full depth a bucket stays as it is: its rows share too many bits, and chains hold them.
    fits = levels.drop("n").join(sizes, ["depth", "bucket"]).filter((F.col("size") <= capacity) | (F.col("depth") == depth))
    first = fits.groupBy("cell").agg(F.min("depth").alias("depth"))
    entries = first.withColumn("bucket", F.floor(
        F.col("cell") / F.pow(F.lit(2.0), F.lit(depth) - F.col("depth"))).cast("long"))
    return depth, stored(entries, "directory")


def build_index(docs: DataFrame, rows: DataFrame, path: str, bits: int = HASH_BITS, capacity: int = CAPACITY) -> DataFrame:
    """Writes the index of distinct texts, one folder per bucket, and returns it.

    Columns: ``bucket_name``, ``hash``, ``text_sha256``, ``keep_id`` (smallest id; null if no row has one),
    ``group_size``, ``chain`` (place among the texts of one hash, 0 unless hashes collide).
    """
    depth, entries = directory(rows, bits, capacity)
    text = normalised()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(text, bits).alias("hash"), text.alias("text"))
    groups = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    chain = F.row_number().over(Window.partitionBy("hash").orderBy("text_sha256")) - 1
    named = groups.withColumn("cell", _prefix(F.col("hash"), depth, bits)).join(entries, "cell", "left")
    named = named.withColumn("bucket_name", F.concat_ws("-", "depth", "bucket")).withColumn("chain", chain)
    (named.select("bucket_name", "hash", "text_sha256", "keep_id", "group_size", "chain").hint("rebalance", "bucket_name")
     .write.partitionBy("bucket_name").parquet(path))
    schema = "hash long, text_sha256 string, keep_id long, group_size long, chain int, bucket_name string"
    return docs.sparkSession.read.schema(schema).parquet(path)


def exact_groups(docs: DataFrame, bits: int = HASH_BITS, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for every row of ``docs``.

    Texts are equal when they are the same bytes after normalising; null is an empty text.  Of a group the
    row with the smallest id stays; nulls come after all ids, and of rows that repeat that id one stays.
    Only ``doc_id`` and ``text`` are read.
    """
    text = normalised()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"))
    rows = rows.select("doc_id", text_hash(F.col("_text"), bits).alias("hash"), F.sha2("_text", 256).alias("text_sha256"),
                       F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "hashes")  # row numbers are fixed by being written
    index = build_index(docs, rows, new_folder(docs.sparkSession, "hash-index"), bits, capacity)
    shared = index.filter("group_size > 1").select("hash", "text_sha256", "keep_id", "group_size")
    out = spread_join(rows, shared, ["hash", "text_sha256"], "row")
    out = out.select("doc_id", "hash", "text_sha256", "row", F.coalesce("group_size", F.lit(1)).alias("group_size"),
                     F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"))
    out = stored(out.withColumn("first", F.col("doc_id").eqNullSafe(F.col("keep_id"))), "groups")
    # Rows that repeat the kept id.
    ties = out.filter("first AND group_size > 1").groupBy("hash", "text_sha256").agg(
        F.min("row").alias("only"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    out = spread_join(out, ties, ["hash", "text_sha256"], "row")
    return out.select("doc_id", "keep_id", "group_size", (F.col("first") & (
        F.col("only").isNull() | (F.col("only") == F.col("row")))).alias("kept"), "text_sha256")


def one_per_text(docs: DataFrame, bits: int = HASH_BITS, capacity: int = CAPACITY) -> DataFrame:
    """Rows of ``docs``, all columns, that ``exact_groups`` keeps.  Of rows that repeat the kept id and its text one stays."""
    return with_plain_names(docs, ("doc_id", "text"), lambda rows: _one_per_text(rows, bits, capacity))


def _one_per_text(docs: DataFrame, bits: int, capacity: int) -> DataFrame:
    groups = exact_groups(docs, bits, capacity)
    dropped = stored(groups.filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("keep_id").alias("_keep"),
                                                      F.unhex("text_sha256").alias("_print")), "copies")
    rows = docs.withColumn("_sha", F.unhex(F.sha2(normalised(), 256)))
    # Whole texts are shuffled only where the ids of the copies are too many to be sent to them.
    others = if_small(stored(dropped.filter("NOT _id <=> _keep").select("_id", "_print").distinct(), "other-copies"))
    rows = rows.join(others, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_print")), "left_anti")
    repeated = dropped.filter("_id <=> _keep").select("_id", "_print").distinct()
    if repeated.isEmpty():
        return rows.drop("_sha")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_print"))
    once = rows.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "_sha"])
    return rows.join(repeated, same, "left_anti").union(once).drop("_sha")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
