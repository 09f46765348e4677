"""Exact Jaccard self-join of documents on word shingles, by size-banded tiles with bitmap signatures.

A document is the sorted array of hashes of its distinct shingles.  Equal sets are one node.  The range of hashes is
cut into parts, so many for each class of sizes.  Two sets that link differ in few elements, so in few parts, and they
share one of the first parts, whole, of each under any common order of parts by what they hold; the order puts parts
with many elements first and does not count elements that are frequent in the corpus.  A chosen part nearly always holds
two elements or more, so sets that share single shingles or a common passage by chance seldom meet.  Small sets, and the
few whose elements fill too few parts, meet by single elements (the first ``n - ceil(similarity * n) + 1``) instead.
What is frequent is read off a part of the documents; it only orders, so no link depends on it.
Nodes that share a part (its digest is a key) form clusters (connected through one hub per key: no pairs are made).  Inside a cluster, nodes go to tiles by size band, and only tiles of equal or adjacent bands
are compared.  A tile comparison bounds every overlap from above by the bit counts of hashed bitmaps and
intersects the sorted arrays exactly where the bound does not exclude a link.  Nodes of a tile that are already
connected are not compared again, and a tile returns a spanning forest of its links, so a large group of
near copies gives as many rows as it has members.

Elements are 64-bit hashes; that two different shingles of one comparison collide is left out of account
(about 1e-7 for a hundred million distinct shingles).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.common import (batches, connected, if_small, no_collector, rows_of, small_batches, spread_join, stored,
                                  whole_text, with_plain_names)

WORDS = 5
# Similarity as a fraction of whole numbers.
LINK = (80, 100)
# Frequent elements are kept as bits of a table of fixed size (8 MB), which is all that is broadcast; two elements on one
# bit cost time only.  Frequent is what several of every FREQUENT_OF distinct texts have; where those elements would fill more
# than a share of the table, only the most frequent of them are.
TABLE_BITS = 1 << 26
TABLE_SHARE = 16
MOST_COUNTED = 1000
FREQUENT_OF = 32
# First size of each class but the first, whose sets are not cut.  A set is cut into PART_SHARE of the first size of its class, so
# a part holds 1.1 to 2.7 elements on average.
CLASSES = [16]
while CLASSES[-1] < 1 << 40:
    CLASSES.append(CLASSES[-1] * 12 // 5)
PART_SHARE = (10, 11)
# Bits of a key and of the short name of a set.
KEY_BITS, NODE_BITS = 48, 40
# What one tile holds.
TILE_DOCS, TILE_ELEMENTS = 512, 1_000_000
# Nodes whose exact overlaps with one node are taken at a time.
SLICE = 32
CACHE_WORDS = 400_000

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                               0x27D4EB2F165667C5)]


class _Words(dict):
    """Word (bytes) -> 64-bit hash; emptied when full."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, hashes: dict, width: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a UTF-8 text; A-Z are lower-cased, words end at ASCII white space.
    Fewer words than ``width`` are one shingle; no words, none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - width + 1
    if n < 1:
        whole = np.array([len(h)], np.uint64)
        for value in h:
            whole = _mixed(whole * _MIX[0] + value)
        return whole
    total = np.zeros(n, np.uint64)
    for k in range(width):  # a different odd multiplier per place
        total = _mixed(total * _MIX[0] + h[k:k + n] * _MIX[1 + k % 4])
    return np.unique(total)


def prefix_length(n: int, link=LINK) -> int:
    return n - -(-link[0] * n // link[1]) + 1 if n else 0


def size_bands(most: int, link=LINK) -> np.ndarray:
    """First size of each band; sizes that may link lie in one band or in adjacent ones."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(starts[-1] * link[1] // link[0] + 1)
    return np.array(starts)


_BANDS = size_bands(1 << 40)


def _table_of(spark: SparkSession, elements: DataFrame, column: str) -> np.ndarray:
    """Bits of a fixed-size table at the hashes in ``column``; the driver reads TABLE_BITS / 64 numbers at most."""
    slots = elements.select(F.pmod(F.col(column), F.lit(TABLE_BITS)).alias("slot"))
    words = slots.groupBy(F.expr("shiftright(slot, 6)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 AS int)))").alias("bits"))
    table = np.zeros(TABLE_BITS // 64, np.uint64)
    found = words.toArrow()
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def _bound(counts: DataFrame) -> int:
    """Smallest number of documents above which elements are few enough for the table."""
    rows = counts.groupBy(F.least("docs", F.lit(MOST_COUNTED)).alias("docs")).agg(F.count(F.lit(1)).alias("n"))
    room, bound = TABLE_BITS // TABLE_SHARE, MOST_COUNTED
    for docs, n in sorted(((r["docs"], r["n"]) for r in rows.collect()), reverse=True):  # MOST_COUNTED rows at most
        room -= n
        if room < 0:
            return bound
        bound = docs - 1
    return 1


def _marked(table: np.ndarray, elements: np.ndarray) -> np.ndarray:
    slot = elements % np.uint64(TABLE_BITS)  # TABLE_BITS is a power of two: the same for signed numbers
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("node", pa.int64()),
                   ("keys", pa.list_(pa.int64()))])
_ELEMENTS = pa.schema([("elements", pa.list_(pa.int64()))])
_ARRAYS = pa.schema([("doc_id", pa.int64()), ("print", pa.binary()), ("elements", pa.binary())])
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _print(elements: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None


def _node(printed: bytes) -> int:
    """Short name of a set while clusters are sought; two sets of one name would only be compared needlessly."""
    return int.from_bytes(printed[:8], "little") >> (64 - NODE_BITS)


def _passed(docs: DataFrame, schema: pa.Schema, ddl: str, make) -> DataFrame:
    """Rows that ``make(doc_id, text, hashes)`` returns, over all documents."""
    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Words()
        with no_collector():
            for ids, texts in rows_of(iterator, "doc_id", "text"):
                rows = [row for i, t in zip(ids, texts) for row in make(i, t, hashes)]
                yield batches(schema.names, list(zip(*rows)) if rows else [[]] * len(schema.names), schema)

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(run, ddl)


def _key(digests: np.ndarray, kind: int) -> np.ndarray:
    return _mixed(digests * _MIX[0] + np.uint64(kind)) >> np.uint64(64 - KEY_BITS)


def keys_of(x: np.ndarray, late: np.ndarray, link=LINK) -> np.ndarray:
    """Keys of a set, of which two sets that link have one in common.  ``late`` marks the frequent elements.

    Of two linked sets, ``a * union <= b * intersection``, so they differ in ``(n + n') * (b - a) / (a + b)`` elements at most
    and in no more parts.  Where one of them has more parts with elements than that, a part is equal in both, and the first
    of these in the common order has fewer than that many others before it in either.  Where both have not, both give elements."""
    a, b = link
    n, keys, single = len(x), [], False
    if not n:
        return np.empty(0, np.int64)
    most = (n + n * b // a) * (b - a) // (a + b)
    # A partner may be of a lower class; the class of the smaller of the two counts.
    for k in range(bisect_right(CLASSES, -(-n * a // b)), bisect_right(CLASSES, n) + 1):
        if not k:
            single = True
            continue
        parts = np.uint64(min(CLASSES[k - 1], 1 << 31) * PART_SHARE[0] // PART_SHARE[1])
        part = (x >> np.uint64(32)) * parts >> np.uint64(32)  # rises with x
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        rare = np.add.reduceat((~late).astype(np.int64), starts)
        first = np.argsort(-rare, kind="stable")[:most + 1]
        keys.append(_key(np.add.reduceat(_mixed(x * _MIX[2]), starts)[first], k))
        single = single or len(starts) <= most
    if single:
        keys.append(_key(np.concatenate([x[~late], x[late]])[:prefix_length(n, link)], 0))
    return np.concatenate(keys).astype(np.int64)


def _sets(docs, frequent, width, link):
    def make(doc_id, text, hashes):
        x = shingles(text, hashes, width)
        printed = _print(x)
        return [(doc_id, len(x), printed, _node(printed) if printed else None, keys_of(x, _marked(frequent, x), link))]

    return _passed(docs, _SETS, "doc_id long, n long, print binary, node long, keys array<long>", make)


def _frequent(docs, width) -> np.ndarray:
    """Table of the elements that several of one in FREQUENT_OF distinct texts have."""
    some = docs.select(whole_text().alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(FREQUENT_OF)) == 0).distinct()
    some = _passed(some.select(F.lit(0).alias("doc_id"), "text"), _ELEMENTS, "elements array<long>",
                   lambda _, text, hashes: [(shingles(text, hashes, width).view(np.int64),)])
    counts = some.select(F.explode("elements").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
    several = stored(counts.filter("docs > 1"), "shingle-counts")
    return _table_of(docs.sparkSession, several.filter(F.col("docs") > _bound(several)), "key")


def _marked_id(table: np.ndarray, doc_id) -> bool:
    return doc_id is not None and bool(_marked(table, np.array([doc_id], np.int64).view(np.uint64))[0])


def _arrays(docs, wanted, width):
    def make(doc_id, text, hashes):
        if not _marked_id(wanted, doc_id):
            return []
        x = shingles(text, hashes, width)
        return [(doc_id, _print(x), x.tobytes())] if len(x) else []

    return _passed(docs, _ARRAYS, "doc_id long, print binary, elements binary", make)


# -- one tile against itself or another --------------------------------------------------------

def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 64-bit words per set, about eight bits per element of the largest."""
    bits = 256
    while bits < 8 * max(map(len, sets)) and bits < 1 << 20:
        bits *= 2
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for row, x in zip(out, sets):
        slot = (x >> np.uint64(17)) % np.uint64(bits)
        np.bitwise_or.at(row, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    return out


def tile_links(sets: list[np.ndarray], sides: np.ndarray | None = None, link=LINK) -> list[tuple[int, int]]:
    """Positions of linked sets, as a spanning forest of all links.  With ``sides`` (0 or 1 per set) only sets of
    different sides are compared."""
    a, b = link
    order = np.argsort([len(x) for x in sets], kind="stable")
    sets = [sets[i] for i in order]
    sides = None if sides is None else np.asarray(sides)[order]
    n = np.array([len(x) for x in sets])
    maps = _bitmaps(sets)
    ones = np.bitwise_count(maps).sum(1).astype(np.int64)
    group, out = np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        last = np.searchsorted(n, n[i] * b // a, "right")  # larger sets cannot link
        others = np.arange(i + 1, last)
        others = others[group[others] != group[i]]
        if sides is not None:
            others = others[sides[others] != sides[i]]
        if not len(others):
            continue
        both = np.empty(len(others), np.int64)
        for at in range(0, len(others), 256):
            both[at:at + 256] = np.bitwise_count(maps[others[at:at + 256]] & maps[i]).sum(1)
        # A bit that only one side has stands for at least one element that only that side has.
        most = np.minimum(n[i] - (ones[i] - both), n[others] - (ones[others] - both))
        possible = b * most >= a * (n[i] + n[others] - most)
        others, most = others[possible], most[possible]
        others = others[np.argsort(-most, kind="stable")]
        while len(others):
            part, others = others[:SLICE], others[SLICE:]
            joined = np.concatenate([sets[j] for j in part])
            place = np.minimum(np.searchsorted(sets[i], joined), n[i] - 1)
            starts = np.concatenate([[0], np.cumsum(n[part])[:-1]])
            overlap = np.add.reduceat((sets[i][place] == joined).astype(np.int64), starts)
            for j in part[b * overlap >= a * (n[i] + n[part] - overlap)]:
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    out.append((int(order[i]), int(order[j])))
            others = others[group[others] != group[i]]
    return out


def _compare(link):
    def run(rows):
        ids = rows.column("rep").to_pylist()
        clusters = np.array(rows.column("cluster").to_pylist())
        sides = np.array(rows.column("side").to_pylist())
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("elements").to_pylist()]
        found = []
        by = np.argsort(clusters, kind="stable")
        for members in np.split(by, np.flatnonzero(np.diff(clusters[by])) + 1):
            two = sides[members].any()  # else one tile against itself
            for i, j in tile_links([sets[k] for k in members], sides[members] if two else None, link):
                found.append((ids[members[i]], ids[members[j]]))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))], schema=_LINKS)

    return run


def _tiles(members: DataFrame, link) -> DataFrame:
    """``rep``, ``print``, ``cluster`` and the tile comparisons (``job``, ``side``) that each node takes part in."""
    spark = members.sparkSession
    cuts = _BANDS[_BANDS < (1 << 31)].tolist()
    members = members.withColumn("band", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("n"))))
    totals = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("elements"))
    small = (F.col("docs") <= TILE_DOCS) & (F.col("elements") <= TILE_ELEMENTS)
    totals = stored(totals.withColumn("small", small), "clusters")
    # Small clusters share jobs of about one tile's size.
    whole = totals.filter("small").agg(F.coalesce(F.sum("elements"), F.lit(0))).first()[0]
    jobs = max(1, -(-2 * whole // TILE_ELEMENTS))
    rows = spread_join(members, totals.select("cluster", "small"), ["cluster"], "rep", how="inner")
    shared = rows.filter("small").select(
        "rep", "print", "cluster", F.concat(F.lit("shared-"), F.pmod(F.xxhash64("cluster"), F.lit(jobs))).alias("job"),
        F.lit(0).alias("side"))
    large = rows.filter("not small")
    bands = large.groupBy("cluster", "band").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / TILE_DOCS), F.ceil(F.sum("n") / TILE_ELEMENTS)).alias("tiles"))
    near = bands.select("cluster", F.col("band").alias("_band"), F.col("tiles").alias("_tiles"))
    partners = bands.join(near.withColumnRenamed("cluster", "_c"), (F.col("cluster") == F.col("_c"))
                          & (F.abs(F.col("band") - F.col("_band")) <= 1)).select("cluster", "band", "tiles", "_band", "_tiles")
    partners = partners.groupBy("cluster", "band", "tiles").agg(F.collect_list(F.struct("_band", "_tiles")).alias("near"))
    placed = spread_join(large, partners, ["cluster", "band"], "rep", how="inner")
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("rep", "print"), F.col("tiles")))
    placed = placed.withColumn("other", F.explode("near")).select("*", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("other._tiles") - 1)).alias("_tile"))
    mine, theirs = F.struct("band", "tile"), F.struct(F.col("other._band").alias("band"), F.col("_tile").alias("tile"))
    first, second = F.least(mine, theirs), F.greatest(mine, theirs)
    job = F.concat_ws("-", F.lit("tiles"), "cluster", first["band"], first["tile"], second["band"], second["tile"])
    return shared.union(placed.select("rep", "print", "cluster", job.alias("job"), (mine > theirs).cast("int").alias("side")))


def similar_components(docs: DataFrame, width: int = WORDS, link=LINK) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id that links reach, for every row of ``docs``.

    Documents link when ``link[1] * intersection >= link[0] * union``.  Null and empty texts, and texts without
    words, have no shingles and link with nothing.  A row without an id has no component and links nothing.
    Rows of one id are linked with each other.  Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    sets = stored(_sets(docs, _frequent(docs, width), width, link), "shingle-sets")
    nodes = stored(sets.filter("print IS NOT NULL AND doc_id IS NOT NULL").groupBy("print").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("node").alias("node"), F.count(F.lit(1)).alias("copies")),
        "shingle-nodes")

    # One hub per key that several nodes have.  Rows are shuffled once, whatever the share of keys that meet.
    rows = sets.filter("print IS NOT NULL AND doc_id IS NOT NULL").select(F.explode("keys").alias("key"), "node")
    so_far = Window.partitionBy("key").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.select(F.col("node").alias("u"), F.first("node").over(so_far).alias("v")).filter("u <> v")
    clusters = connected(near, "clusters").withColumnsRenamed({"node": "_node", "component": "cluster"})
    members = stored(nodes.join(clusters, F.col("node") == F.col("_node")).select("rep", "print", "n", "cluster"), "cluster-members")

    arrays = _arrays(docs, _table_of(spark, members, "rep"), width).withColumnsRenamed({"doc_id": "_id", "print": "_p"})
    tiles = _tiles(members, link)
    work = tiles.join(arrays, (F.col("rep") == F.col("_id")) & (F.col("print") == F.col("_p")))
    links = work.select("rep", "cluster", "job", "side", "elements").groupBy("job").applyInArrow(_compare(link), "u long, v long")

    # Rows of one id that stand in different nodes.
    copies = nodes.filter("copies > 1").select("print", "rep")
    rows = spread_join(sets.select("doc_id", "n", "print"), copies, ["print"], "doc_id")
    rows = stored(rows.select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "shingle-rows")
    twice = rows.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("u")).filter("u <> v")
    same = rows.join(twice.select(F.col("doc_id").alias("_id"), "v"), F.col("doc_id") == F.col("_id")).select(
        F.col("rep").alias("u"), "v")
    found = connected(links.union(same), "shingle-links")
    out = spread_join(rows, found.withColumnRenamed("node", "rep"), ["rep"], "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component", "rep").alias("component_id"))


def one_per_component(docs: DataFrame, width: int = WORDS, link=LINK) -> DataFrame:
    """Rows of ``docs``, all columns, less those whose id is not the smallest of its component."""
    def kept(rows: DataFrame) -> DataFrame:
        parts = similar_components(rows, width, link)
        dropped = stored(parts.filter("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct(), "near-copies")
        return rows.join(if_small(dropped), F.col("doc_id") == F.col("_dropped"), "left_anti")

    return with_plain_names(docs, ("doc_id", "text"), kept)
