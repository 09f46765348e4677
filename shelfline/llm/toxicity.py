"""Toxicity by a factorization machine over hashed terms.

Terms are the letters-only words of a text and their first four to six letters (so that inflected forms share
terms), hashed.  A linear weight per term and a small factor vector per term are learned together; the
inner products of factor vectors score pairs of terms, e.g. an insult next to a mention of a group,
which no sum of single weights can tell apart.  Training reads a bounded sample of the labelled rows;
scoring is a pass over all texts with a model of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import batches, rows_of, small_batches, whole_text
from shelfline.llm.quality_classifier import held_out

# At most so many labelled rows train, those of the smallest hash of their id, half of each class where there are enough.
TRAIN_ROWS = 12_000
HASH_BITS = 28
PREFIXES = (4, 5, 6)
# Terms that enter the machine: in so many sample rows at least, with so many deviations from independence, and no more than this.
LEAST_ROWS, LEAST_Z, MOST_TERMS = 4, 4.0, 20_000
FACTORS, EPOCHS, RATE, PULL = 4, 12, 0.15, 1e-5
CACHE_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_SAMPLE = pa.schema([("label", pa.int32()), ("terms", pa.binary())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def hashed_terms(word: str) -> tuple[int, ...]:
    """Hashes of a lower-case word and of its prefixes."""
    mask = (1 << HASH_BITS) - 1
    terms = [word] + [f"{word[:k]}*" for k in PREFIXES if len(word) >= k]
    return tuple(zlib.crc32(t.encode()) & mask for t in terms)


class _Words(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = self.make(word)
        return value


def distinct_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def sample_terms(rows: DataFrame) -> DataFrame:
    """``label`` and the distinct hashed terms (bytes of 32-bit integers) of each row."""
    small_batches(rows.sparkSession)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of = _Words(hashed_terms)
        for labels, texts in rows_of(iterator, "label", "text"):
            terms = [np.unique(np.fromiter((t for w in distinct_words(x) for t in terms_of[w]), "<u4")).tobytes()
                     for x in texts]
            yield batches(_SAMPLE.names, [labels, terms], _SAMPLE)

    return rows.select(F.col("label").cast("int").alias("label"), whole_text().alias("text")).mapInArrow(
        run, "label int, terms binary")


class Machine:
    """Linear weights and factors by hashed term; ``place`` maps a hash to its row."""

    def __init__(self, bias: float, place: dict[int, int], weights: np.ndarray, factors: np.ndarray):
        self.bias, self.place, self.weights, self.factors = bias, place, weights, factors

    def margin(self, rows) -> float:
        """``rows``: places of the distinct terms of one text."""
        if not len(rows):
            return self.bias
        v = self.factors[rows]
        pairs = 0.5 * float((v.sum(0) ** 2).sum() - (v ** 2).sum())
        return self.bias + float(self.weights[rows].sum()) + pairs

    def probability(self, rows) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(rows), -40, 40))))


def fit(samples: list[tuple[int, bytes]], factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> Machine | None:
    """Adaptive gradient steps, one row at a time.  None if a class is missing."""
    labels = np.array([label for label, _ in samples], float)
    if not len(labels) or labels.min() == labels.max():
        return None
    terms = [np.frombuffer(t, "<u4") for _, t in samples]
    names, back = np.unique(np.concatenate(terms), return_inverse=True)
    owner = np.repeat(labels, [len(t) for t in terms])
    rows, ones = np.bincount(back, minlength=len(names)), np.bincount(back, owner, len(names))
    rate = labels.mean()
    z = (ones - rows * rate) / np.sqrt(np.maximum(rows * rate * (1 - rate), 1e-9))
    chosen = np.flatnonzero((rows >= LEAST_ROWS) & (np.abs(z) >= LEAST_Z))
    if len(chosen) > MOST_TERMS:
        chosen = chosen[np.argsort(-np.abs(z[chosen]), kind="stable")[:MOST_TERMS]]
    place = {int(names[c]): i for i, c in enumerate(chosen)}
    slot = np.full(len(names), -1)
    slot[chosen] = np.arange(len(chosen))
    cuts = np.cumsum([len(t) for t in terms])[:-1]
    inputs = [s[s >= 0] for s in np.split(slot[back], cuts)]

    random = np.random.default_rng(seed)
    weights, v = np.zeros(len(chosen)), random.normal(0, 0.01, (len(chosen), factors))
    gw, gv, bias, gb = np.full(len(chosen), 1e-2), np.full((len(chosen), factors), 1e-2), float(np.log(rate / (1 - rate))), 1.0
    for _ in range(epochs):
        for k in random.permutation(len(inputs)):
            at = inputs[k]
            x = v[at]
            total = x.sum(0)
            margin = bias + weights[at].sum() + 0.5 * float((total ** 2).sum() - (x ** 2).sum())
            error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[k]
            gb += error * error
            bias -= RATE * error / np.sqrt(gb)
            if not len(at) or abs(error) < 1e-4:
                continue
            step_w, step_v = error + PULL * weights[at], error * (total - x) + PULL * x
            gw[at] += step_w ** 2
            gv[at] += step_v ** 2
            weights[at] -= RATE * step_w / np.sqrt(gw[at])
            v[at] -= RATE * step_v / np.sqrt(gv[at])
    return Machine(bias, place, weights, v)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0,
          train_rows: int = TRAIN_ROWS) -> Machine | None:
    """Fits on at most ``train_rows`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("label")).filter("label IN (0, 1)").filter(
        ~held_out(F.col("_id"), modulus, remainder))
    picked = None
    for label in (0, 1):  # the sample's ids and labels only; a top-k by hash is the same however rows are partitioned
        part = known.filter(F.col("label") == label).orderBy(F.xxhash64("_id"), "_id").limit(train_rows // 2)
        picked = part if picked is None else picked.union(part)
    # The sample of ids has at most train_rows rows of two numbers, which bounds the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    found = sample_terms(rows).limit(2 * train_rows).collect()
    return fit(sorted((r["label"], bytes(r["terms"])) for r in found))


def toxicity_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    Null and empty texts have no terms and get the machine's bias; without labels of both classes
    every text scores 0.  Null ids are held out; repeated rows are scored each.  Only ``doc_id`` and
    ``text`` are read.
    """
    model = train(docs, labels, modulus, remainder)
    small_batches(docs.sparkSession)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = model.place if model else {}
        rows_for = _Words(lambda w: tuple(place[t] for t in hashed_terms(w) if t in place))
        for ids, texts in rows_of(iterator, "doc_id", "text"):
            scores = []
            for text in texts:
                found = {r for rows in map(rows_for.__getitem__, distinct_words(text)) for r in rows}
                scores.append(model.probability(sorted(found)) if model else 0.0)
            yield batches(_SCORES.names, [ids, scores], _SCORES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
