"""Mixture-controlled packing of documents into token sequences by deficit round-robin.

Each source is a queue of documents.  Time is cut into windows of ``window_sequences`` full sequences.
In every window a source earns its quantum, its target share of the window's tokens; it sends
documents while what it has earned so far covers them, and what is left over is carried on.  So a
document leaves in the first window in which the source's earnings reach the end of that document in
its queue.  That rule needs only the running token count of the queue, which is what makes it a Spark job:
windows, places in windows and places in sequences are sums over counts per (source, block),
per (window, source) and per block of windows, and deficits cross windows and partitions by themselves.

The token stream made this way is cut every ``sequence_tokens`` ids, so only the last sequence is
not full.  Only counts are planned; ids meet the plan in one join at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from shelfline.llm.common import batches, no_collector, rows_of, small_batches, spread_join, stored, whole_text
from shelfline.llm.word_bpe import VOCABULARY, Chunks, WordBPE, byte_array, encoder, parts_of

SEQUENCE_TOKENS = 2048
WINDOW_SEQUENCES = 64
END_ID = 1
# Documents that one sorted block of a queue holds on average.
BLOCK_DOCS = 20_000
# Windows whose totals one task adds up.
WINDOW_BLOCK = 1024
CACHE_CHUNKS = 500_000
# Text whose words are put into one dictionary.
SLICE_BYTES = 3_000_000

_TOKENS = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("doc_tokens", pa.int64()),
                     ("tokens", pa.binary())])
def _width(path: str) -> str:
    """Ids are kept as 16-bit numbers if the vocabulary allows."""
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 65536 else "<u4"


def _gathered(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to at least ``SLICE_BYTES`` of text, so that a word is looked up for many texts at once."""
    held, size = [], 0
    for batch in iterator:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size >= SLICE_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``SLICE_BYTES`` of text; a longer text is a slice of its own."""
    size, at = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
        if size and size + n > SLICE_BYTES:
            yield batch.slice(at, i - at)
            size, at = 0, i
        size += n
    if at < len(batch):
        yield batch.slice(at)


def _encoded(texts: pa.Array, bpe: WordBPE, encoded: Chunks, width: str) -> list[bytes]:
    """Ids of every text.  The words of all texts become numbers of a dictionary, only its entries are encoded, and their
    ids (as bytes) are taken by these numbers, one after the other."""
    words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    numbered = words.flatten().dictionary_encode()
    ends, ids = parts_of(bpe.ids_of_chunks(numbered.dictionary, encoded))
    ids = ids.view("<i4").astype(width)
    by_entry = byte_array(np.diff(ends) // 4 * ids.itemsize, ids.tobytes())
    stream = by_entry.take(numbered.indices)
    _, bounds, data = stream.buffers()
    bounds = np.frombuffer(bounds, np.int64)[stream.offset:stream.offset + len(stream) + 1] if len(stream) else np.zeros(1, np.int64)
    data = memoryview(data or b"")
    cuts = bounds[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
    return [bytes(data[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``source``, ``doc_tokens`` and ``tokens`` (bytes) of every document, the end id last."""
    small_batches(docs.sparkSession)
    width = _width(path)
    step = int(width[-1])

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoded = encoder(path, CACHE_CHUNKS)
        end = np.array([end_id], width).tobytes()
        try:
            with no_collector():
                for batch in _gathered(iterator):
                    for rows in _slices(batch):
                        tokens = [t + end for t in _encoded(rows.column("text"), bpe, encoded, width)]
                        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("source"),
                                                          pa.array([len(t) // step for t in tokens], pa.int64()),
                                                          pa.array(tokens, pa.binary())], schema=_TOKENS)
        finally:  # workers live on between stages: what a task learnt (100 MB and more) would stay through all of them
            encoded.empty()
            bpe.forget()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, doc_tokens long, tokens binary")


def plan(lengths: DataFrame, targets: dict[str, float] | None = None, window_tokens: int = SEQUENCE_TOKENS * WINDOW_SEQUENCES,
         block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Place of every document in the packed stream.

    ``lengths``: ``row`` (unique), ``source``, ``doc_tokens`` (1 or more).  ``targets``: positive weights of
    sources; a source without one gets its share of all tokens, as all do by default.  Null is a
    source.  Result: ``row``, ``window``, ``place`` (ids before the document in the whole stream).
    """
    totals = lengths.groupBy("source").agg(F.sum("doc_tokens").alias("_tokens"), F.count(F.lit(1)).alias("_docs"))
    every = totals.agg(F.sum("_tokens").cast("double")).scalar()
    share = F.col("_tokens") / every
    for source, weight in (targets or {}).items():
        share = F.when(F.col("source") == source, F.lit(float(weight))).otherwise(share)
    totals = totals.select("source", (F.greatest(share, F.lit(1e-12)) * window_tokens).alias("_quantum"),
                           F.ceil(F.col("_docs") / block_docs).alias("_blocks"))
    rows = spread_join(lengths.select("row", "source", "doc_tokens"), totals, ["source"], "row", how="inner")
    # The queue's order: by block, a hash of the row, and then by row.  A hot source has many blocks.
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("row"), F.col("_blocks")))
    before = Window.partitionBy("source", "_block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("doc_tokens").over(before), F.lit(0)))
    blocks = rows.groupBy("source", "_block").agg(F.sum("doc_tokens").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_first"))
    rows = rows.join(blocks.withColumnsRenamed({"source": "_s", "_block": "_b"}),
                     F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    rows = rows.withColumn("_start", F.col("_first") + F.col("_inside"))
    # Earnings after window w are (w + 1) quanta; the first w that covers the document's last id.
    rows = rows.withColumn("window", F.floor((F.col("_start") + F.col("doc_tokens") - 1) / F.col("_quantum")))
    queued = stored(rows.select("row", "source", "doc_tokens", "_start", "window"), "queues")

    cells = queued.groupBy("window", "source").agg(F.sum("doc_tokens").alias("_sum"), F.min("_start").alias("_low"))
    cells = cells.withColumn("_part", F.floor(F.col("window") / WINDOW_BLOCK))
    in_part = Window.partitionBy("_part").orderBy("window", "source").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_inside", F.coalesce(F.sum("_sum").over(in_part), F.lit(0)))
    parts = cells.groupBy("_part").agg(F.sum("_sum").alias("_total"))
    # One row per WINDOW_BLOCK windows: a few bytes for every 100 million ids or so.
    parts = parts.select("_part", F.coalesce(F.sum("_total").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    cells = cells.join(parts, "_part").select(
        F.col("window").alias("_w"), F.col("source").alias("_s"),
        (F.col("_before") + F.col("_inside") - F.col("_low")).alias("_shift"))
    return queued.join(cells, (F.col("window") == F.col("_w")) & F.col("source").eqNullSafe(F.col("_s"))).select(
        "row", "window", (F.col("_start") + F.col("_shift")).alias("place"))


_PIECES = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("window", pa.int64()), ("ids", pa.binary())])


def pack(docs: DataFrame, path: str | None = None, targets: dict[str, float] | None = None,
         sequence_tokens: int = SEQUENCE_TOKENS, window_sequences: int = WINDOW_SEQUENCES,
         block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``source``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``window`` and ``ids`` (little-endian unsigned 32-bit integers).

    A null or empty text is one piece of the end id alone.  Rows that repeat, or whose id is null, are
    documents of their own.  An empty table gives no pieces.  Only ``doc_id``, ``source`` and ``text`` are read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    width = _width(path)
    # Tokenised once; the row number is fixed by being written.
    tokens = stored(tokenize(docs, path).withColumn("row", F.monotonically_increasing_id()), "tokens")
    placed = plan(tokens.select("row", "source", "doc_tokens"), targets, sequence_tokens * window_sequences, block_docs)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "source", "doc_tokens", "tokens", "window", "place")
        for columns in rows_of(iterator, *names):
            out = [[] for _ in _PIECES.names]
            for doc_id, source, n, data, window, place in zip(*columns):
                ids, start = np.frombuffer(data, width).astype("<u4"), 0
                while start < n:
                    at = (place + start) % sequence_tokens
                    length = min(n - start, sequence_tokens - at)
                    piece = (doc_id, source, start, length, n, (place + start) // sequence_tokens, at, window,
                             ids[start:start + length].tobytes())
                    for column, value in zip(out, piece):
                        column.append(value)
                    start += length
            yield batches(_PIECES.names, out, _PIECES)

    return tokens.join(placed, "row").select("doc_id", "source", "doc_tokens", "tokens", "window", "place").mapInArrow(
        run, "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, "
             "offset long, window long, ids binary")


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "source", "window")
