"""Periodic runs of words in a text, found on its Re-Pair grammar.

A run is a stretch of consecutive words with smallest period ``q``, at least ``max(12, 2 q)`` words long, that no
neighbouring word extends keeping the period.

A text becomes the array of its word ids.  Re-Pair replaces the most frequent pair of neighbouring symbols by a new
nonterminal until no pair is left twice; pairs of one frequency that cannot overlap are replaced in one step, which is
what replacing them one after the other gives.  What remains is joined by a balanced tree.  A run has a smallest
nonterminal (or tree node) that holds it, and crosses the boundary between its two children.  So the runs that cross a
boundary are computed once per nonterminal, at its first occurrence: a period ``q`` is possible only where the word
behind the boundary stands ``q`` words before it, or the word before the boundary ``q`` words behind, and the two longest common
extensions around such a pair give the run.  Every one is then translated to all positions at which the
nonterminal was put in, and of the intervals of one period the maximal ones are kept.

Whatever lies in a run belongs to six words that stand in the text twice, so the grammar is made of the stretches
of such words only; all others are left out exactly, and a text that repeats no six words has no run.

The work is per text, in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import batches, no_collector, rows_of, small_batches

LEAST = 12
# Any run repeats this many consecutive words.
GRAM = LEAST // 2
# Boundary candidates that are extended at a time.
SLICE = 1 << 20

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                         0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def word_ids(words: list) -> np.ndarray:
    number = defaultdict(count().__next__)
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def repeated_stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Longest stretches, all of whose words belong to ``GRAM`` words that stand in the text twice.

    Equal hashes of different words only make a stretch longer than it needs to be."""
    n = len(ids) - GRAM + 1
    if n < 2:
        return []
    mixed = np.zeros(n, np.uint64)
    word = ids.astype(np.uint64) + np.uint64(1)
    for k in range(GRAM):
        mixed += word[k:k + n] * _MULTIPLIERS[k]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return []
    starts = np.zeros(len(ids) + 1, np.int64)
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    starts[at] += 1
    starts[at + GRAM] -= 1
    covered = np.concatenate([[False], np.cumsum(starts[:-1]) > 0, [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)
    return [(a, b) for a, b in edges.tolist() if b - a >= LEAST]


# -- the grammar --------------------------------------------------------------------------------

def _free(symbols: np.ndarray) -> np.ndarray:
    """Places of pairs, less those of two equal symbols that overlap the one before."""
    equal = symbols[1:] == symbols[:-1]
    free = np.ones(len(equal), bool)
    if equal.any():
        place = np.arange(len(equal))
        first = np.maximum.accumulate(np.where(equal, -1, place))  # last place before, where the symbols differ
        free[equal] = ((place - first)[equal] % 2) == 1
    return free


def _together(pairs: list[tuple[int, int]]) -> list[int]:
    """Positions of pairs that can be replaced in one step: either pairs of equal symbols, or pairs of which no
    symbol is left in one and right in another."""
    equal = [i for i, (x, y) in enumerate(pairs) if x == y]
    if equal:
        return equal
    side, chosen = {}, []
    for i, (x, y) in enumerate(pairs):
        if side.get(x, 0) == 0 and side.get(y, 1) == 1:
            side[x], side[y] = 0, 1
            chosen.append(i)
    return chosen


def grammar(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start, boundary and end of the first occurrence of every nonterminal, and the starts of all its
    occurrences in the derivation of ``ids``."""
    symbols, starts = ids.copy(), np.arange(len(ids))
    fresh = int(ids.max()) + 1 if len(ids) else 0
    node, places = [], []
    while len(symbols) > 1:
        at = np.flatnonzero(_free(symbols))
        code = symbols[at] * np.int64(fresh) + symbols[at + 1]
        kinds, first, inverse, counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        most = counts.max()
        if most < 2:
            break
        top = np.flatnonzero(counts == most)
        top = top[np.argsort(first[top], kind="stable")]
        pairs = [(int(k) // fresh, int(k) % fresh) for k in kinds[top].tolist()]
        top = top[_together(pairs)]
        new = np.full(len(kinds), -1, np.int64)
        new[top] = fresh + np.arange(len(top))
        put = new[inverse]
        here = put >= 0
        at, put = at[here], put[here]
        ends = np.append(starts, len(ids))
        order = np.argsort(put, kind="stable")  # occurrences of one nonterminal together, in the order of the text
        for group in np.split(at[order], np.arange(1, len(top)) * int(most)):
            a = group[0]
            node.append((starts[a], ends[a + 1], ends[a + 2]))
            places.append(starts[group])
        symbols[at] = put
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, starts = symbols[stay], starts[stay]
        fresh += len(top)
    cuts = np.append(starts, len(ids))
    while len(cuts) > 2:  # what is left has no repeated pair: a balanced tree above it
        for i in range(0, len(cuts) - 2, 2):
            node.append((cuts[i], cuts[i + 1], cuts[i + 2]))
            places.append(cuts[i:i + 1])
        cuts = np.unique(np.append(cuts[::2], cuts[-1]))
    lo, mid, hi = np.array(node, np.int64).reshape(-1, 3).T
    return lo, mid, hi, places


# -- extensions ---------------------------------------------------------------------------------

def _ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Per power of two, numbers that are equal where that many words from a place on are."""
    ranks = [ids]
    while 2 << (len(ranks) - 1) <= len(ids):
        last, step = ranks[-1], 1 << (len(ranks) - 1)
        both = last[:-step] * (int(last.max()) + 1) + last[step:]
        ranks.append(np.unique(both, return_inverse=True)[1])
    return ranks


def _forward(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of equal words from ``i`` and ``j`` on (``i < j``), below ``end``."""
    length = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        fits = np.flatnonzero(j + length + (1 << k) <= end)
        fits = fits[ranks[k][i[fits] + length[fits]] == ranks[k][j[fits] + length[fits]]]
        length[fits] += 1 << k
    return length


def _backward(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Number of equal words before ``i`` and ``j`` (``i < j``), from ``start`` on."""
    length = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        fits = np.flatnonzero(i - length - (1 << k) >= start)
        fits = fits[ranks[k][i[fits] - length[fits] - (1 << k)] == ranks[k][j[fits] - length[fits] - (1 << k)]]
        length[fits] += 1 << k
    return length


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of the same words of one node under several periods the smallest period, which divides the others."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[keep]


def _crossing(ids, ranks, lo, mid, hi) -> tuple[np.ndarray, ...]:
    """``node, start, end, period`` of the runs that cross the boundary of a node, inside the node."""
    n, found = len(ids), []
    key = np.sort(ids * np.int64(n) + np.arange(n))
    half = (hi - lo) // 2
    # The word behind the boundary, earlier; the word before the boundary, later.
    for word, first, last in ((mid, np.maximum(lo, mid - half), mid), (mid - 1, mid, np.minimum(hi, mid + half))):
        of = ids[word] * n
        a, b = np.searchsorted(key, of + first), np.searchsorted(key, of + last)
        many = np.cumsum(b - a)
        cuts = np.unique(np.searchsorted(many, np.arange(SLICE, (many[-1] if len(many) else 0) + SLICE, SLICE), "left") + 1)
        begin = 0
        for stop in np.minimum(cuts, len(word)).tolist():
            which = np.repeat(np.arange(begin, stop), (b - a)[begin:stop])
            if len(which):
                skip = np.cumsum((b - a)[begin:stop]) - (b - a)[begin:stop]
                other = key[np.arange(len(which)) - np.repeat(skip, (b - a)[begin:stop]) + a[which]] - of[which]
                i, j = np.minimum(other, word[which]), np.maximum(other, word[which])
                start = i - _backward(ranks, i, j, lo[which])
                end = j + _forward(ranks, i, j, hi[which])
                good = end - start >= np.maximum(LEAST, 2 * (j - i))
                found.append(_smallest(np.stack([which, start, end, j - i], 1)[good]))
            begin = stop
    return _smallest(np.concatenate(found) if found else np.empty((0, 4), np.int64)).T


def _maximal(start, end, period) -> list[tuple[int, int, int]]:
    """Intervals of one period that overlap by the period are one; of equal ones the smallest period stays."""
    merged = []
    for q, s, e in sorted(zip(period.tolist(), start.tolist(), end.tolist())):
        if merged and merged[-1][0] == q and s + q <= merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([q, s, e])
    least = {}
    for q, s, e in merged:  # by period
        least.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in least.items())


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period."""
    out = []
    for a, b in repeated_stretches(ids):
        part = np.unique(ids[a:b], return_inverse=True)[1]
        lo, mid, hi, places = grammar(part)
        node, start, end, period = _crossing(part, _ranks(part), lo, mid, hi)
        if not len(node):
            continue
        times = np.array([len(places[k]) for k in node.tolist()])
        move = np.concatenate([places[k] - lo[k] for k in node.tolist()])
        found = _maximal(np.repeat(start, times) + move, np.repeat(end, times) + move, np.repeat(period, times))
        out += [(s + a, length, q) for s, length, q in found]
    return out


# -- over documents -----------------------------------------------------------------------------

def planted(words: list, doc_id: int | None) -> list:
    """The words of a document, in one of ten made periodic from a place on; the id alone decides."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run has behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_FIELDS = ([("doc_id", pa.int64()), ("n_runs", pa.int64())] + [(c, pa.int64()) for c in ("start", "length", "period", "exponent_milli")]
           + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_OUT = pa.schema(_FIELDS)
_ALL = pa.schema([*_FIELDS, ("runs", pa.list_(pa.list_(pa.int64()))), ("collapsed", pa.binary())])


def _row(doc_id, words: list, schema: pa.Schema) -> list:
    runs = runs_of(word_ids(words)) if len(words) >= LEAST else []
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    text = b" ".join(collapsed(words, runs))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    row = [doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
           hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()]
    return row + [runs, text] if "runs" in schema.names else row


def _runs(schema: pa.Schema, change):
    def run(iterator: Iterator[pa.RecordBatch]):
        with no_collector():
            for ids, texts in rows_of(iterator, "doc_id", "text"):
                rows = [_row(i, change((t or b"").split(), i), schema) for i, t in zip(ids, texts)]
                yield batches(schema.names, list(zip(*rows)) if rows else [[]] * len(schema), schema)

    return run


_DDL = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
        "collapsed_sha256 string")


def periodic_runs(docs: DataFrame, digests_only: bool = False, plant: bool = False) -> DataFrame:
    """Per row of ``docs`` the number of runs, the longest one (ties: smallest start, then period; nulls without one),
    digests, and unless ``digests_only`` all ``runs`` (start, length, period) and the ``collapsed`` text (UTF-8 bytes).

    Null and empty texts have no words and no run.  Every row is judged alone, so rows that repeat, or have no id, give a row each.
    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, are left out.  ``plant`` makes
    one document in ten periodic before the search (a row without an id stays as it is).
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    ddl = _DDL if digests_only else f"{_DDL}, runs array<array<long>>, collapsed binary"
    change = planted if plant else lambda words, _: words
    return rows.mapInArrow(_runs(_OUT if digests_only else _ALL, change), ddl)
