"""Document quality by a regularised quadratic discriminant over transformed text statistics.

Per class, mean and covariance of the statistics come from one aggregate over all labelled rows.  The
covariances are shrunk towards the pooled diagonal, and their Cholesky factors are inverted once; a score is then
a difference of two Mahalanobis log densities, written as plain column arithmetic.  A two-parameter
logistic curve, fitted to a histogram of that difference, turns it into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from shelfline.llm.common import small_batches, stored, with_plain_names

SHRINKAGE = 0.1
# Bins and reach of the histogram that calibrates the difference of log densities.
BINS, REACH = 400, 200.0
_SPACE, _UPPER, _DIGITS = ([*b" \t\n\x0b\x0c\r"], [*range(65, 91)], [*range(48, 58)])
_SYMBOLS, _MARKS, _LATER = [*b"#*$%&|<>"], [*b"!?.,;:"], [*range(128, 192)]  # the last: inner bytes of a character
STATISTICS = ("words", "word_length", "distinct", "upper", "symbols", "marks", "digits", "lines", "repeated_lines")


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of one whole text in UTF-8; an empty text has zeros."""
    words = text.split()  # of bytes: exactly ASCII white space
    lines = [line for line in text.split(b"\n") if line.strip()]
    bytes_of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    characters = int(bytes_of.sum() - bytes_of[_LATER].sum() - bytes_of[_SPACE].sum())
    n = len(words)

    def share(part, whole):
        return math.sqrt(part / max(whole, 1))

    return [
        math.log1p(n),
        math.log1p(characters / max(n, 1)),
        len(set(words)) / max(n, 1),
        share(bytes_of[_UPPER].sum(), characters),
        share(bytes_of[_SYMBOLS].sum(), characters),
        share(bytes_of[_MARKS].sum(), characters),
        share(bytes_of[_DIGITS].sum(), characters),
        math.log1p(n / max(len(lines), 1)),
        share(len(lines) - len(set(lines)), len(lines)),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs``, all columns as they are, with one array column ``_x``."""
    small_batches(docs.sparkSession)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            x = pa.array([statistics(t or b"") for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, x], names=[*batch.schema.names, "_x"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_x", ArrayType(DoubleType()))]))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Rows that training never sees; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


@dataclass
class Discriminant:
    """Per class (0, 1): mean, inverse Cholesky factor of the covariance, log density constant; and the curve."""

    means: list[list[float]]
    factors: list[list[list[float]]]
    constants: list[float]
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: Column) -> Column:
        """Log density of class 1 less that of class 0, at the statistics in array ``x``."""
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            gaps = [F.get(x, F.lit(j)) - F.lit(mean[j]) for j in range(len(mean))]
            squares = []
            for i, row in enumerate(factor):
                projected = gaps[0] * F.lit(row[0])
                for j in range(1, i + 1):
                    projected = projected + gaps[j] * F.lit(row[j])
                squares.append(projected * projected)
            total = squares[0]
            for square in squares[1:]:
                total = total + square
            density.append(F.lit(constant) - total / 2)
        return density[1] - density[0]

    def score(self, x: Column) -> Column:
        z = F.least(F.greatest(self.difference(x), F.lit(-REACH)), F.lit(REACH))
        return 1 / (1 + F.exp(-(z * F.lit(self.slope) + F.lit(self.offset))))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant | None:
    """``labelled``: ``_x`` and ``label`` (0 or 1; others are left out).  None if a class has fewer than two rows."""
    d = len(STATISTICS)
    rows = labelled.filter("label IN (0, 1)").select(F.col("label").cast("int").alias("label"), "_x")
    cells = [(i, j) for i in range(d) for j in range(i + 1)]

    def x(i):
        return F.get("_x", F.lit(i))

    moments = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x(i)).alias(f"s{i}") for i in range(d)],
        *[F.sum(x(i) * x(j)).alias(f"p{i}_{j}") for i, j in cells])
    found = {r["label"]: r for r in moments.collect()}  # two rows at most
    if len(found) < 2 or min(r["n"] for r in found.values()) < 2:
        return None
    means, covariances, counts = [], [], []
    for label in (0, 1):
        r = found[label]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.zeros((d, d))
        for i, j in cells:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
        counts.append(r["n"])
    pooled = sum(c * n for c, n in zip(covariances, counts)) / sum(counts)
    between = sum(np.outer(m, m) * n for m, n in zip(means, counts)) / sum(counts)
    centre = sum(m * n for m, n in zip(means, counts)) / sum(counts)
    target = np.diag(np.diag(pooled) + np.diag(between) - centre ** 2 + 1e-6)
    factors, constants = [], []
    for covariance, n in zip(covariances, counts):
        # Few rows say little of a covariance, so they are shrunk more.
        weight = max(shrinkage, d / (n + d))
        factor = np.linalg.cholesky((1 - weight) * covariance + weight * target)
        factors.append(np.linalg.inv(factor).tolist())
        constants.append(float(-np.log(np.diag(factor)).sum() + math.log(n / sum(counts))))
    model = Discriminant([m.tolist() for m in means], factors, constants)
    model.slope, model.offset = _curve(rows, model)
    return model


def _curve(rows: DataFrame, model: Discriminant) -> tuple[float, float]:
    """Logistic curve through the class counts per bin of the clipped difference."""
    z = F.least(F.greatest(model.difference(F.col("_x")), F.lit(-REACH)), F.lit(REACH))
    bins = rows.groupBy(F.floor((z + REACH) / (2 * REACH) * BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"), F.avg(z).alias("z")).collect()  # BINS + 1 rows at most
    z, n, ones = (np.array([float(b[c]) for b in bins]) for c in ("z", "n", "ones"))
    slope, offset = 0.1, 0.0
    for _ in range(60):  # Newton steps, with a weak pull that keeps separable classes finite
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -500, 500)))
        w = n * p * (1 - p)
        gradient = np.array([((ones - n * p) * z).sum() - 1.0 * slope, (ones - n * p).sum() - 0.01 * offset])
        hessian = np.array([[(w * z * z).sum() + 1.0, (w * z).sum()], [(w * z).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        scale = min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        slope, offset = slope + scale * step[0], offset + scale * step[1]
    return float(max(slope, 1e-6)), float(offset)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1,
          shrinkage: float = SHRINKAGE) -> Discriminant | None:
    """Fits on all labelled rows that are not held out.  A document that is labelled twice counts twice."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")).filter(
        "label IN (0, 1)").filter(~held_out(F.col("_id"), modulus, remainder))
    # Statistics first: the join then moves a few numbers per document and no text.
    seen = docs.select("doc_id", "text").filter(~held_out(F.col("doc_id"), modulus, remainder))
    rows = with_statistics(seen).select("doc_id", "_x")
    rows = rows.join(known, F.col("doc_id") == F.col("_id")).select("label", "_x")
    return fit(stored(rows, "quality-statistics"), shrinkage)


def score(docs: DataFrame, model: Discriminant | None, column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1.  Without a model (a class has no labels) all score 0.5."""
    if model is None:
        return docs.withColumn(column, F.lit(0.5))
    return with_statistics(docs).withColumn(column, model.score(F.col("_x"))).drop("_x")


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    Null and empty texts are scored like any text, with all statistics zero.  Null ids are held out;
    repeated rows are scored each.  Only ``doc_id`` and ``text`` are read.
    """
    model = train(docs, labels, modulus, remainder)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """Rows of ``docs``, all columns, that the classifier does not reject."""
    model = train(docs, labels, modulus, remainder)
    return with_plain_names(docs, ("doc_id", "text"), lambda rows: score(rows, model, "_score").filter("_score >= 0.5").drop("_score"))
