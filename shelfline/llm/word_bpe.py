"""Byte-pair encoding with word ends, by a contiguous rank array per word; and its decoding.

The vocabulary file (JSON) gives merges, ids, the added tokens, the normaliser and the splitter.
The merging is done here.  A word's parts lie in one list and the ranks of adjacent parts in a second
one.  The smallest rank is searched by a scan, the boundary is deleted, and the two neighbouring
ranks are looked up again.  Words of more than ``SCAN_LIMIT`` parts, where repeated scans would cost the
square of the length, are merged in the same order from a heap over linked parts; results are equal.

Words repeat, so a worker keeps the encoding of the white-space separated chunks that it has met.
The store is emptied at ``CACHE_CHUNKS`` entries: memory is bounded, results do not depend on it.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm.common import no_collector, rows_of, small_batches, whole_text

VOCABULARY = "word_bpe_49k.json"
SCAN_LIMIT = 96
CACHE_CHUNKS = 400_000
LONGEST_CACHED = 64
# Words that are merged as rows of one matrix: so many letters, so many words.
LONGEST_LEARNED = 24
MERGED_TOGETHER = 2048
# Characters that str.split() takes as white space and the vocabulary's splitter does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_OTHER_SPLIT = re.compile("[ \t\n\r\x0b\x0c]+")
# Visible Latin-1 text is already in normal form, and its letters and numbers are few, so it needs no library call.
_LATIN = re.compile("[!-~\xa1-\xff]+")
_LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
                          "|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                          "|[^a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")


def _byte_alphabet() -> dict[int, str]:
    """Byte -> visible character: itself if visible in Latin-1, else the next free one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_alphabet()
_RAW = {c: b for b, c in _BYTES.items()}
# Bytes of visible Latin-1 text but ', and the kind of a character (letter 0, number 1, other 2) of one byte and of two (C2 and C3 first).
_VISIBLE = np.array([0x21 <= b <= 0x7E and b != 0x27 or 0x80 <= b <= 0xBF or b in (0xC2, 0xC3) for b in range(256)])


def _kind(c: str) -> int:
    return 0 if re.fullmatch("[a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]", c) else 1 if re.fullmatch("[0-9\xb2\xb3\xb9\xbc-\xbe]", c) else 2


_KINDS = np.array([_kind(chr(b)) if b < 0x80 else 2 for b in range(256)])
_KINDS_2 = np.array([_kind(chr(b)) for b in range(0x80, 0x100)])


def parts_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds from 0 on and bytes of an array of large binaries."""
    _, bounds, data = values.buffers()
    if not len(values):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    bounds = np.frombuffer(bounds, np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.empty(0, np.uint8)
    return bounds - bounds[0], data


def byte_array(sizes: np.ndarray, data: bytes) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


class IdArrays:
    """Distinct entries and their ids, both as arrays of bytes.  Long entries are not kept, and over ``most`` only those last met."""

    def __init__(self, most: int):
        self.most = most
        self.empty()

    def __len__(self):
        return len(self.entries)

    def empty(self) -> None:
        self.entries = self.ids = pa.array([], pa.large_binary())

    def of(self, entries: pa.Array, make) -> pa.Array:
        at = pc.index_in(entries, value_set=self.entries).fill_null(-1).to_numpy().astype(np.int64)
        fresh = entries.filter(pa.array(at < 0))
        made = make(fresh)
        at[at < 0] = len(self) + np.arange(len(fresh))
        found = pa.concat_arrays([self.ids, made]).take(pa.array(at))
        if len(self) + len(fresh) > self.most:
            self.empty()
            fresh, made = (entries, found) if len(entries) <= self.most // 2 else (self.entries, self.ids)
        short = pc.less_equal(pc.binary_length(fresh), LONGEST_CACHED)
        self.entries = pa.concat_arrays([self.entries, fresh.filter(short)])
        self.ids = pa.concat_arrays([self.ids, made.filter(short)])
        return found


class WordBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(map(tuple, model["merges"]))}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        if sys.byteorder != "little" or array("i").itemsize != 4:
            raise RuntimeError("ids are kept as little-endian 32-bit integers")
        # What added tokens look like inside: the quick path leaves such chunks alone.
        if any("<|" not in t for t in self.added):
            raise ValueError("added tokens are expected to contain <|")
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        # Only Unicode normal form, lower case and the splitting pattern come from the library.
        library = Tokenizer.from_file(path)
        self._normal, self._split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self._words: dict[str, bytes] = {}
        self._sorted: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self._byte_ids: tuple[np.ndarray, np.ndarray] | None = None
        self.chunk_arrays, self.word_arrays = IdArrays(CACHE_CHUNKS), IdArrays(CACHE_CHUNKS)

    # -- merging ---------------------------------------------------------------------------
    def merge(self, word: str) -> list[str]:
        """Tokens of one word (byte alphabet, no white space)."""
        parts = [*word[:-1], word[-1] + self.end]
        if len(parts) > SCAN_LIMIT:
            return self._merge_long(parts)
        rank = self.ranks.get
        none = len(self.ranks)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            parts[at] += parts[at + 1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same merges, smallest rank and then leftmost first, in n log n."""
        rank, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i] = left + right
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p, live in zip(parts, alive) if live]

    def _word(self, word: str) -> bytes:
        """Ids of one word, little-endian 32-bit integers."""
        ids = self._words.get(word)
        if ids is None:
            numbers = self.ids
            ids = array("i", [numbers[t] for t in self.merge(word)]).tobytes()
            if len(word) <= LONGEST_CACHED:
                if len(self._words) >= CACHE_CHUNKS:
                    self._words.clear()
                self._words[word] = ids
        return ids

    # -- many words at once ------------------------------------------------------------------
    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merges as sorted whole numbers (left id, right id), their ranks, and the id that each rank makes."""
        if self._sorted is None:
            keys = np.array([(self.ids[a] << 32) | self.ids[b] for a, b in self.ranks], np.int64)
            ranks = np.fromiter(self.ranks.values(), np.int64, len(keys))
            made = np.empty(len(keys) + 1, np.int64)
            made[ranks] = [self.ids[a + b] for a, b in self.ranks]
            order = np.argsort(keys)
            self._sorted = np.append(keys[order], np.iinfo(np.int64).max), np.append(ranks[order], len(keys)), made
        return self._sorted

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, ranks, _ = self._pairs()
        key = (left << 32) | right
        at = np.searchsorted(keys, key)
        return np.where((keys[at] == key) & (left >= 0) & (right >= 0), ranks[at], len(self.ranks))

    def merge_many(self, words: list[str]) -> list[bytes]:
        """Ids of words (byte alphabet) that are not empty, little-endian 32-bit integers."""
        raw = [bytes(map(_RAW.__getitem__, w)) for w in words]
        return self._merged(pa.array(raw, pa.large_binary())).to_pylist()

    def _merged(self, words: pa.Array) -> pa.Array:
        """Ids (bytes) of words (UTF-8, in lower case, not empty); words of about one length are merged together."""
        bounds, data = parts_of(words)
        size = np.diff(bounds)
        order = np.argsort(size, kind="stable")
        counts, ids = [np.empty(0, np.int64)], []
        for at in range(0, len(order), MERGED_TOGETHER):
            part = order[at:at + MERGED_TOGETHER]
            place = np.arange(size[part[-1]])
            inside = place < size[part][:, None]
            letters = data[np.where(inside, bounds[part][:, None] + place, 0)]
            inner, last = self._letters()
            last_one = place == size[part][:, None] - 1
            done = self._merge_rows(np.where(inside, np.where(last_one, last[letters], inner[letters]), -1))
            kept = done >= 0
            counts.append(kept.sum(1))
            ids.append(done[kept].astype("<i4"))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return byte_array(np.concatenate(counts) * 4, b"".join([x.tobytes() for x in ids])).take(pa.array(back))

    def _letters(self) -> tuple[np.ndarray, np.ndarray]:
        """Id of every byte inside a word and at its end."""
        if self._byte_ids is None:
            self._byte_ids = (np.array([self.ids[_BYTES[b]] for b in range(256)]),
                              np.array([self.ids[_BYTES[b] + self.end] for b in range(256)]))
        return self._byte_ids

    def _merge_rows(self, parts: np.ndarray) -> np.ndarray:
        """The rank arrays of the words are the rows of a matrix, and every round deletes in each row the boundary of its leftmost smallest rank and refreshes the two ranks beside it."""
        ranks = self._ranks_of(parts[:, :-1], parts[:, 1:])
        none, made = len(self.ranks), self._pairs()[2]
        live, done = np.arange(len(parts)), parts.copy()
        place = np.arange(parts.shape[1])
        while len(live) and ranks.shape[1]:
            at = ranks.argmin(1)
            least = ranks[np.arange(len(live)), at]
            ended = least == none
            if ended.any():
                done[live[ended]] = parts[ended]
                live, parts, ranks, at, least = (x[~ended] for x in (live, parts, ranks, at, least))
                if not len(live):
                    break
            i = np.arange(len(live))
            parts[i, at] = made[least]
            behind = place[:-1] > at[:, None]  # all places behind the deleted boundary move up by one
            parts[:, :-1] = np.where(behind, parts[:, 1:], parts[:, :-1])
            parts[:, -1] = -1
            ranks[:, :-1] = np.where(behind[:, :-1] | (place[:-2] == at[:, None]), ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            ranks[i, at] = self._ranks_of(parts[i, at], parts[i, at + 1])
            i, at = i[at > 0], at[at > 0]
            ranks[i, at - 1] = self._ranks_of(parts[i, at - 1], parts[i, at])
        return done

    def forget(self) -> None:
        """Drops the words met so far."""
        self._words.clear()
        self.chunk_arrays.empty()
        self.word_arrays.empty()

    def ids_of_chunks(self, chunks: pa.Array, known: Chunks) -> pa.Array:
        """Ids (bytes) of distinct chunks (large strings), empty ones too; what is new is learnt for the next call."""
        return self.chunk_arrays.of(chunks.cast(pa.large_binary()), lambda new: self._ids_of_new(new, known))

    def _ids_of_new(self, chunks: pa.Array, known: Chunks) -> pa.Array:
        """Chunks of visible Latin-1 text without ' or <| are split and merged as arrays of bytes, others one by one."""
        bounds, data = parts_of(chunks)
        before = np.concatenate([[0], data[:-1]]).astype(np.uint8)
        odd = ~_VISIBLE[data] | ((before == 0xC2) & (data < 0xA1)) | ((before == ord("<")) & (data == ord("|")))
        count = np.concatenate([[0], np.cumsum(odd)])
        single = count[bounds[1:]] > count[bounds[:-1]]
        one_by_one = [known[c.decode()] for c in chunks.filter(pa.array(single)).to_pylist()]
        known.trim()
        size = np.diff(bounds)
        data = data[np.repeat(~single, size)]
        size = size[~single]
        starts = np.concatenate([[0], np.cumsum(size)])
        # Lower case: A-Z, and from U+00C0 to U+00DE all but the multiplication sign.
        before = np.concatenate([[0], data[:-1]]).astype(np.uint8)
        upper = ((data >= 65) & (data <= 90)) | ((before == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97))
        data = data + upper.astype(np.uint8) * np.uint8(32)
        # Words as the splitting pattern finds them: runs of letters, single numbers, runs of others.
        at = np.flatnonzero((data & 0xC0) != 0x80)
        after = np.concatenate([data[1:], [0]])[at]
        kind = np.where(data[at] < 0x80, _KINDS[data[at]], _KINDS_2[(data[at] & 1) * 64 + (after & 0x3F)])
        first = np.zeros(len(data) + 1, bool)
        first[starts] = True
        cut = first[at] | (kind == 1) | (np.concatenate([[-1], kind[:-1]]) != kind)
        cuts = np.append(at[cut], len(data))
        words = byte_array(np.diff(cuts), data.tobytes()).dictionary_encode()
        ids = self.word_arrays.of(words.dictionary, self._ids_of_words).take(words.indices)
        ends, ids = parts_of(ids)
        done = byte_array(np.diff(ends[np.searchsorted(cuts, starts)]), ids.tobytes())
        place = np.empty(len(single), np.int64)
        place[~single], place[single] = np.arange(len(done)), len(done) + np.arange(len(one_by_one))
        return pa.concat_arrays([done, pa.array(one_by_one, pa.large_binary())]).take(pa.array(place))

    def _ids_of_words(self, words: pa.Array) -> pa.Array:
        long = np.diff(parts_of(words)[0]) > LONGEST_LEARNED
        short = self._merged(words.filter(pa.array(~long)))
        rest = [self._word(w.decode("latin-1").translate(_BYTES)) for w in words.filter(pa.array(long)).to_pylist()]
        place = np.empty(len(long), np.int64)
        place[~long], place[long] = np.arange(len(short)), len(short) + np.arange(len(rest))
        return pa.concat_arrays([short, pa.array(rest, pa.large_binary())]).take(pa.array(place))

    # -- chunks and texts -------------------------------------------------------------------
    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of text without ASCII white space; an added token is found before normalising."""
        if _LATIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join([self._word(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTES))
                             for w in _LATIN_WORDS.findall(chunk.lower())])
        out = []
        for i, part in enumerate(self.marks.split(chunk) if self.marks else (chunk,)):
            if i % 2:
                out.append(array("i", [self.added[part]]).tobytes())
            elif part:
                out += [self._word(word) for word, _ in self._split(self._normal(part))]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(map(self.chunk_ids, chunks(text))), "<i4").tolist()

    def token_array(self) -> np.ndarray:
        """Token by id."""
        out = np.full(max(self.tokens) + 1, "", object)
        for i, token in self.tokens.items():
            out[i] = token
        return out

    def decode(self, ids) -> str:
        """The vocabulary has no decoder step: tokens are joined by one space."""
        return " ".join(self.tokens[i] for i in ids)


def chunks(text: str) -> list[str]:
    return _OTHER_SPLIT.split(text) if _NOT_SPACE.search(text) else text.split()


class Chunks(dict):
    """Chunk -> ``make(chunk)``, computed when first met.  ``trim`` bounds it between texts."""

    def __init__(self, make, most: int = CACHE_CHUNKS):
        super().__init__()
        self.make, self.most, self.long = make, most, 0

    def __missing__(self, chunk):
        return self.put(chunk, self.make(chunk))

    def put(self, chunk, value):
        self[chunk] = value
        self.long += len(chunk) if len(chunk) > LONGEST_CACHED else 0
        return value

    def empty(self) -> None:
        self.clear()
        self.long = 0

    def trim(self) -> None:
        if len(self) > self.most or self.long > 1_000_000:
            self.empty()


_ENCODERS: dict[str, tuple[WordBPE, Chunks]] = {}


def encoder(path: str, most: int = CACHE_CHUNKS) -> tuple[WordBPE, Chunks]:
    """The vocabulary and its chunk store (ids as little-endian 32-bit integers), one per worker process."""
    if path not in _ENCODERS:
        bpe = WordBPE(path)
        _ENCODERS[path] = (bpe, Chunks(bpe.chunk_ids, most))
    return _ENCODERS[path]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes every text and decodes the ids again: ``doc_id``, ``ids`` (array of int), ``decoded`` (string).

    Null and empty texts have no ids and decode to the empty string.  One row per input row, so repeated
    rows and null ids stay.  Only ``doc_id`` and ``text`` are read; other columns do not matter.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    small_batches(docs.sparkSession)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoded = encoder(path)
        tokens = bpe.token_array()
        with no_collector():
            for doc_ids, texts in rows_of(iterator, "doc_id", "text"):
                data, ends, decoded = [], [0], []
                for text in texts:
                    data.append(b"".join(map(encoded.__getitem__, chunks(text))))
                    encoded.trim()
                    ends.append(ends[-1] + len(data[-1]) // 4)
                    decoded.append(" ".join(tokens[np.frombuffer(data[-1], "<i4")].tolist()))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), ids, pa.array(decoded)], schema=_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def token_digests(encoded: DataFrame) -> DataFrame:
    """Number of ids and digests of the result of ``encode_and_decode``."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
