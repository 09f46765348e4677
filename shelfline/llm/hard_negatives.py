"""Hard negatives of anchors by a secondary sort.

An anchor's other rows, ordered by descending score (inner product of whole-number vectors), then by id, are its ranking.
Its positives are the first rows of its label.  Around a positive, a hard negative is a row of another label
whose score lies between a share of the positive's score and that score.

Scores become sort keys: anchor, descending score, positives first, id, packed into bytes that sort as they should.  One
shuffle deals them by anchor and sorts them inside the partitions (``repartition`` and ``sortWithinPartitions``, the
DataFrame form of ``repartitionAndSortWithinPartitions``).  A streaming iterator walks over the sorted keys: a
positive opens a window, and the negatives that follow are emitted into the open windows until these are full or the score
falls below them.  It holds the open windows of one anchor and no anchor's rows.

Anchors are a stated part of all rows, and each is scored against every row, in blocks: a task gets one block of
anchors and one of rows.  What a block already excludes never becomes a key: a first pass keeps a block's first
positives of each anchor and finds the windows by the same sorted walk; a second keeps, per window, the block's first
negatives inside it.  Both are exact, since the first ones of all rows are among the first ones of their blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import BATCH_ROWS, batches, stored

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 5
# A negative's score is at least this share of the positive's, as a fraction of whole numbers.
FLOOR = (80, 100)
SCALE = 256
# Rows of a block; scores that a task holds at a time.
ANCHOR_BLOCK, ROW_BLOCK, SCORES = 4096, 8192, 1 << 22
LOW, HIGH = -(1 << 63), (1 << 63) - 1


# -- scores -------------------------------------------------------------------------------------

def whole_numbers(vectors: pa.ChunkedArray) -> np.ndarray:
    """``floor(SCALE * x)`` of equally long vectors, as doubles."""
    values, n = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False), len(vectors)
    return np.floor(SCALE * values.reshape(n, len(values) // n if n else 0))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b`` (doubles with whole values); beyond a long, its ends."""
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if most < 1 << 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    top = np.finfo(np.float64).max
    big = [[[int(x) for x in row] for row in np.clip(m, -top, top).tolist()] for m in (a, b)]
    out = [[min(HIGH, max(LOW, sum(x * y for x, y in zip(u, v)))) for v in big[1]] for u in big[0]]
    return np.array(out, np.int64).reshape(len(a), len(b))


# -- sort keys ----------------------------------------------------------------------------------

_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("negative", "u1"), ("id", ">u8")])
_TOP = np.uint64(1 << 63)


def packed(anchor, score, negative, other) -> list[bytes]:
    """Byte keys that sort by anchor, descending score, positives first, id."""
    keys = np.empty(len(anchor), _KEY)
    keys["anchor"], keys["id"] = (np.asarray(x, np.int64).view(np.uint64) ^ _TOP for x in (anchor, other))
    keys["score"] = ~(np.asarray(score, np.int64).view(np.uint64) ^ _TOP)
    keys["negative"] = negative
    data, size = keys.tobytes(), _KEY.itemsize
    return [data[i:i + size] for i in range(0, len(data), size)]


def unpacked(keys: list[bytes]) -> zip:
    rows = np.frombuffer(b"".join(keys), _KEY)
    anchor, score, other = (rows[c].astype(np.uint64) for c in ("anchor", "score", "id"))
    return zip((anchor ^ _TOP).view(np.int64).tolist(), (~score ^ _TOP).view(np.int64).tolist(), rows["negative"].tolist(),
               (other ^ _TOP).view(np.int64).tolist())


def _above(positive: int, score: int, floor) -> bool:
    return floor[0] * positive <= floor[1] * score


def walk(keys: Iterator[list[bytes]], positives: int, negatives: int, floor=FLOOR) -> Iterator[tuple]:
    """``(anchor, positive, rank, negative, positive score, negative score)`` from sorted keys."""
    anchor, opened, windows = None, 0, []
    for some in keys:
        for of, score, negative, other in unpacked(some):
            if of != anchor:
                anchor, opened, windows = of, 0, []
            if not negative:
                if opened < positives:
                    opened += 1
                    windows.append([other, score, 0])
                continue
            # Later keys have no higher score: a window that is full or above the score is done.
            windows = [w for w in windows if w[2] < negatives and _above(w[1], score, floor)]
            for w in windows:
                w[2] += 1
                yield anchor, w[0], w[2], other, w[1], score


_MINED = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                    ("positive_score", pa.int64()), ("negative_score", pa.int64())])
_WINDOWS = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("score", pa.int64())])
_KEYS = pa.schema([("anchor", pa.int64()), ("key", pa.binary())])


def _mine(positives: int, negatives: int, floor):
    def run(iterator: Iterator[pa.RecordBatch]):
        rows = []
        for row in walk((b.column("key").to_pylist() for b in iterator), positives, negatives, floor):
            rows.append(row)
            if len(rows) >= BATCH_ROWS:
                yield batches(_MINED.names, list(zip(*rows)), _MINED)
                rows = []
        if rows:
            yield batches(_MINED.names, list(zip(*rows)), _MINED)

    return run


def _first_positives(positives: int):
    def run(iterator: Iterator[pa.RecordBatch]):
        anchor, opened = None, 0
        for batch in iterator:
            rows = []
            for of, score, _, other in unpacked(batch.column("key").to_pylist()):
                anchor, opened = of, opened + 1 if of == anchor else 1
                if opened <= positives:
                    rows.append((of, other, score))
            if rows:
                yield batches(_WINDOWS.names, list(zip(*rows)), _WINDOWS)

    return run


# -- blocks -------------------------------------------------------------------------------------

def _sides(rows: pa.Table):
    """Anchors and rows of a block pair: ids, labels, vectors, and the anchors' windows."""
    anchor = np.array(rows.column("is_anchor").to_pylist(), bool)
    for side in (anchor, ~anchor):
        part = rows.filter(pa.array(side))
        yield (np.array(part.column("vec_id").to_pylist(), np.int64), np.array(part.column("label").to_pylist(), np.int64),
               whole_numbers(part.column("vector")), part.column("windows").to_pylist())


def _slices(n: int, width: int):
    step = max(1, SCORES // max(1, width))
    return (slice(at, at + step) for at in range(0, n if width else 0, step))


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` first by descending score, then id."""
    if len(score) > n:
        cut = np.partition(score, len(score) - n)[len(score) - n]
        place = np.flatnonzero(score >= cut)
    else:
        place = np.arange(len(score))
    return place[np.lexsort((ids[place], -score[place].astype(object) if (score[place] == LOW).any() else -score[place]))][:n]


def _block_positives(n: int):
    def run(rows: pa.Table) -> pa.Table:
        (a_id, a_label, a, _), (b_id, b_label, b, _) = _sides(rows)
        found = [[], [], []]
        for part in _slices(len(a_id), len(b_id)):
            score = scores(a[part], b)
            for k, line in enumerate(score):
                k += part.start
                other = np.flatnonzero((b_label == a_label[k]) & (b_id != a_id[k]))
                take = other[_first(line[other], b_id[other], n)]
                for c, values in zip(found, (np.full(len(take), a_id[k]), line[take], b_id[take])):
                    c.append(values)
        anchor, score, other = (np.concatenate(c) if c else np.empty(0, np.int64) for c in found)
        return pa.Table.from_arrays([pa.array(anchor, pa.int64()), pa.array(packed(anchor, score, 0, other), pa.binary())], schema=_KEYS)

    return run


def _block_negatives(n: int, floor):
    def run(rows: pa.Table) -> pa.Table:
        (a_id, a_label, a, windows), (b_id, b_label, b, _) = _sides(rows)
        found = [[], [], []]
        for part in _slices(len(a_id), len(b_id)):
            score = scores(a[part], b)
            for k, line in enumerate(score):
                k += part.start
                other = np.flatnonzero(b_label != a_label[k])
                here, ids, take = line[other], b_id[other], []
                for top in sorted(set(windows[k])):
                    # floor[0] * top <= floor[1] * score <= floor[1] * top
                    inside = np.flatnonzero((here <= top) & (here >= -(-floor[0] * top // floor[1])))
                    take.append(other[inside[_first(here[inside], ids[inside], n)]])
                take = np.unique(np.concatenate(take)) if take else np.empty(0, np.int64)
                for c, values in zip(found, (np.full(len(take), a_id[k]), line[take], b_id[take])):
                    c.append(values)
        anchor, score, other = (np.concatenate(c) if c else np.empty(0, np.int64) for c in found)
        return pa.Table.from_arrays([pa.array(anchor, pa.int64()), pa.array(packed(anchor, score, 1, other), pa.binary())], schema=_KEYS)

    return run


def _dealt(keys: DataFrame) -> DataFrame:
    return keys.repartition("anchor").sortWithinPartitions("key").select("key")


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (doubles) of the rows that take part.

    Rows with a null id, label or vector, or with a component that is null or not finite, do not.  Of rows with one
    id the first by label, then vector, stands for all."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(~bad)
    twice = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("vec_id").alias("_id"))
    same = F.col("vec_id") == F.col("_id")
    first = rows.join(twice, same, "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r"))
    return rows.join(twice, same, "left_anti").union(first.select("vec_id", "r.label", "r.vector"))


def relabelled(label: Column, vec_id: Column) -> Column:
    """Labels of the rows whose id is divisible by 7 move up by one, modulo 10."""
    return F.when(F.pmod(vec_id, F.lit(7)) == 0, (label + 1) % 10).otherwise(label)


def hard_negatives(vectors: DataFrame, anchors: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   floor=FLOOR, vector: str = "embedding") -> DataFrame:
    """One row per anchor, positive and hard negative: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``
    and both scores.

    ``anchors`` is a condition on ``vec_id`` and ``label``, by default ids divisible by ``ANCHOR_EVERY``.  Ties of scores
    go by the smaller id; a negative may score as high as its positive.  Rows of an anchor's own id are neither its positives nor
    its negatives; see ``usable`` for rows that take no part.  Vectors of different lengths have no score.  Anchors
    without positives, and positives without negatives, have no rows; an empty table gives none.  Columns
    beside ``vec_id``, ``label`` and the vector are not read.
    """
    anchors = F.pmod(F.col("vec_id"), F.lit(ANCHOR_EVERY)) == 0 if anchors is None else anchors
    rows = stored(usable(vectors, vector).withColumns({"width": F.size("vector"), "is_anchor": F.coalesce(anchors, F.lit(False))}),
                  "mining-rows")
    return _mined(rows, positives, negatives, floor)


def _mined(rows: DataFrame, positives: int, negatives: int, floor) -> DataFrame:
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_anchor").cast("long")), F.lit(0))).first()
    row_blocks, anchor_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_anchors // ANCHOR_BLOCK))
    mixed = F.xxhash64("vec_id")

    def placed(part: DataFrame, windows: Column, anchor: bool) -> DataFrame:
        """A row's copies, one per block of the other side."""
        mine, others = (anchor_blocks, row_blocks) if anchor else (row_blocks, anchor_blocks)
        part = part.select("vec_id", "label", "vector", "width", windows.cast("array<long>").alias("windows"), F.lit(anchor).alias("is_anchor"),
                           F.pmod(mixed, F.lit(mine)).alias("mine"))
        part = part.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))
        pair = ("mine", "other") if anchor else ("other", "mine")
        return part.withColumn("block", F.concat_ws("-", "width", *pair)).drop("mine", "other", "width")

    chosen, nothing = rows.filter("is_anchor"), F.array()
    work = placed(chosen, nothing, True).union(placed(rows, nothing, False))
    keys = work.groupBy("block").applyInArrow(_block_positives(positives), "anchor long, key binary")
    windows = stored(_dealt(keys).mapInArrow(_first_positives(positives), "anchor long, positive long, score long"), "mining-windows")

    tops = windows.groupBy("anchor").agg(F.collect_list("score").alias("tops"))  # ``positives`` scores at most
    with_tops = chosen.join(tops, F.col("vec_id") == F.col("anchor"))
    work = placed(with_tops, F.col("tops"), True).union(placed(rows, nothing, False))
    against = work.groupBy("block").applyInArrow(_block_negatives(negatives, floor), "anchor long, key binary")
    opening = windows.mapInArrow(_window_keys, "anchor long, key binary")
    return _dealt(opening.union(against)).mapInArrow(
        _mine(positives, negatives, floor),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _window_keys(iterator: Iterator[pa.RecordBatch]):
    for batch in iterator:
        anchor, other, score = (batch.column(c).to_pylist() for c in _WINDOWS.names)
        yield batches(_KEYS.names, [anchor, packed(anchor, score, 0, other)], _KEYS)


def oracle() -> str:
    """The mining of ``op12_hard_negatives`` in DuckDB SQL."""
    return f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS positive,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE positive
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, p.positive_score,
       s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.positive
  AND {FLOOR[0]} * p.positive_score <= {FLOOR[1]} * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""
