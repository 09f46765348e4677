"""SimHash near-duplicates by a self-join of binary tries.

A document's fingerprint has 64 bits: bit ``b`` is 1 if it is set in more than half of the hashes of the document's
shingles.  Fingerprints link when at most ``ERRORS`` bits differ.

Equal fingerprints are one row before anything else moves.  The 64 bits are cut into parts; two linked fingerprints
agree in all but ``ERRORS`` of the parts, so for every choice of the parts that agree there is one trie over the bits in
the order "these parts first", and in one of the tries the two lie below the same node at that depth.  From these nodes
on, pairs of nodes are traversed together: a pair carries the number of bits in which the two paths differ, gives way to
the pairs of its children, and is left when the number exceeds ``ERRORS``.

Before the join, neighbours in the order of each trie are compared, and what they link gets a component.  A pair of nodes
whose fingerprints are all of one component is left, too: it can add no link between components.  So a large group of
near copies costs little more than its members, and the join gives one link per pair of components that it connects.

Nodes with more fingerprints than a task should hold are split by the same rule as rows of a table of node pairs, some
levels at a time; pairs that are small enough go to tasks, which traverse them to the leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import batches, connected, no_collector, rows_of, small_batches, spread_join, stored

WORDS = 4
SEED = 42
BITS = 64
ERRORS = 4
# Fingerprints that one side of a node pair may bring to a task, and that a task takes of small nodes together.
TILE, TASK = 4096, 16384
# Levels by which the nodes of a table of node pairs are split at a time.
LEVELS = 4
# Node pairs that a task holds at a time; pairs of so few fingerprints are compared one by one.
FRONTIER, LEAF = 1 << 17, 32
# Fingerprints below one node, on average, above which the bits are cut into more parts (more tries, each of them deeper).
NODE = 256


# -- fingerprints -------------------------------------------------------------------------------

def fingerprint(text: bytes, width: int = WORDS) -> int:
    """Majority bits of the hashes of a UTF-8 text's shingles, repeats included; A-Z are lower-cased, words end at ASCII
    white space.  Fewer words than ``width`` are one shingle; no words: zero."""
    words = text.lower().split()
    if not words:
        return 0
    ends = np.fromiter(map(len, words), np.int64, len(words)).cumsum()
    ends += np.arange(len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(width, len(words)) - 1
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    total, n = np.zeros(BITS, np.int64), len(words) - last
    for at in range(0, n, 8192):
        cuts = zip(starts[at:min(at + 8192, n)].tolist(), ends[at + last:min(at + 8192, n) + last].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in cuts])  # eight bytes each, highest first
        total += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


_PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])


def _fingerprints(width: int):
    def run(iterator: Iterator[pa.RecordBatch]):
        with no_collector():
            for ids, texts in rows_of(iterator, "doc_id", "text"):
                prints = np.array([fingerprint(t or b"", width) for t in texts], np.uint64)
                yield batches(_PRINTS.names, [ids, prints.view(np.int64)], _PRINTS)

    return run


# -- orders of the bits -------------------------------------------------------------------------

def orders(n: int, errors: int = ERRORS) -> tuple[int, list[list[tuple[int, int]]]]:
    """For ``n`` fingerprints the depth at which linked ones meet in one of the tries, and per trie the ranges of bits
    (from the highest), in their order.

    With ``errors + k`` parts linked fingerprints agree in ``k`` of them at least; more parts agree in more bits."""
    k = 1
    while True:
        parts = errors + k
        cuts = [BITS * i // parts for i in range(parts + 1)]
        ranges = list(zip(cuts[:-1], cuts[1:]))
        chosen = list(combinations(range(parts), k))
        depth = min(sum(ranges[i][1] - ranges[i][0] for i in c) for c in chosen)
        if n >> depth <= NODE or k == 4:
            return depth, [[ranges[i] for i in c] + [r for i, r in enumerate(ranges) if i not in c] for c in chosen]
        k += 1


def _reordered(column: Column, order: list[tuple[int, int]]) -> Column:
    """The bits of a long in another order."""
    out, at = F.lit(0).cast("long"), BITS
    for a, b in order:
        at -= b - a
        bits = F.shiftrightunsigned(column, BITS - b).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(bits, at))
    return out


def _prefix(code: Column, depth: int) -> Column:
    return F.shiftrightunsigned(code, BITS - depth) if depth else F.lit(0).cast("long")


# -- neighbours in the order of a trie -------------------------------------------------------------

_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _neighbours(errors: int):
    def run(iterator: Iterator[pa.RecordBatch]):
        before = None
        for batch in iterator:
            of, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("trie", "print"))
            if before is not None:
                of, prints = np.append(before[0], of), np.append(before[1], prints)
            if not len(of):
                continue
            before = of[-1:], prints[-1:]
            near = np.bitwise_count((prints[1:] ^ prints[:-1]).view(np.uint64)) <= errors
            near &= of[1:] == of[:-1]
            yield batches(_LINKS.names, [prints[1:][near], prints[:-1][near]], _LINKS)

    return run


# -- traversal in a task ------------------------------------------------------------------------

def _children(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First place in ``lo``..``hi`` whose bit at ``depth`` is set."""
    bit = np.uint64(1) << (np.uint64(BITS - 1) - depth.astype(np.uint64))
    floor = codes[lo] & ~(bit | (bit - np.uint64(1)))
    return np.clip(np.searchsorted(codes, floor | bit), lo, hi)


def node_pairs(codes: np.ndarray, component: np.ndarray, a: np.ndarray, b: np.ndarray, depth: np.ndarray, differ: np.ndarray,
               errors: int = ERRORS) -> list[np.ndarray]:
    """Places (two arrays) of linked codes of different components, below pairs of nodes.

    ``codes`` ascend and differ; ``a`` and ``b`` hold first and behind-last places of nodes, equal for a node with
    itself; at ``depth`` the two paths differ in ``differ`` bits."""
    # Behind the last place from each place on that has the same component.
    change = np.flatnonzero(component[1:] != component[:-1]) + 1
    same_to = np.append(change, len(codes))[np.searchsorted(change, np.arange(len(codes)), "right")]
    stack, found = [(a, b, depth, differ)], []
    while stack:
        a, b, depth, differ = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [tuple(x[:half] for x in (a, b, depth, differ)), tuple(x[half:] for x in (a, b, depth, differ))]
            continue
        one = (same_to[a[:, 0]] >= a[:, 1]) & (same_to[b[:, 0]] >= b[:, 1]) & (component[a[:, 0]] == component[b[:, 0]])
        keep = (differ <= errors) & ~one
        a, b, depth, differ = a[keep], b[keep], depth[keep], differ[keep]
        n, m = a[:, 1] - a[:, 0], b[:, 1] - b[:, 0]
        small = (n * m <= LEAF) | (depth >= BITS)
        if small.any():
            n, m, x, y = n[small], m[small], a[small, 0], b[small, 0]
            pair = np.repeat(np.arange(len(n)), n * m)
            place = np.arange(len(pair)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            i, j = x[pair] + place // m[pair], y[pair] + place % m[pair]
            near = (np.bitwise_count(codes[i] ^ codes[j]) <= errors) & (component[i] != component[j])
            found.append(np.stack([i[near], j[near]]))
            a, b, depth, differ = a[~small], b[~small], depth[~small], differ[~small]
        if not len(a):
            continue
        x, y = _children(codes, a[:, 0], a[:, 1], depth), _children(codes, b[:, 0], b[:, 1], depth)
        itself = a[:, 0] == b[:, 0]
        more = []
        for s in (0, 1):
            left = np.stack([a[:, 0], x] if s == 0 else [x, a[:, 1]], 1)
            for t in (0, 1):
                right = np.stack([b[:, 0], y] if t == 0 else [y, b[:, 1]], 1)
                take = (left[:, 0] < left[:, 1]) & (right[:, 0] < right[:, 1])
                if s > t:
                    take &= ~itself
                more.append((left[take], right[take], depth[take] + 1, differ[take] + (s != t)))
        stack.append(tuple(np.concatenate(p) for p in zip(*more)))
    return found


def _traversed(errors: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, side, codes, component = (rows.column(c).to_numpy() for c in ("node", "side", "code", "component"))
        codes, depth, differ = codes.view(np.uint64), rows.column("depth").to_numpy(), rows.column("differ").to_numpy()
        out = []
        # Node pairs of one task: below one another's side in the order of the codes, whichever pair they belong to.
        order = np.lexsort((codes, side, node))
        node, side, codes, component, depth, differ = (c[order] for c in (node, side, codes, component, depth, differ))
        first = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (side[1:] != side[:-1])]))
        last = np.append(first[1:], len(node))
        # Nodes with themselves: their codes ascend over the whole task, since they are nodes of one trie.
        alone = side[first] == 0
        if alone.any():
            use = np.concatenate([np.arange(s, e) for s, e in zip(first[alone], last[alone])])
            by = use[np.argsort(codes[use], kind="stable")]
            new = np.flatnonzero(np.concatenate([[True], node[by][1:] != node[by][:-1]]))
            ranges = np.stack([new, np.append(new[1:], len(by))], 1)
            for i, j in node_pairs(codes[by], component[by], ranges, ranges, depth[by][new], differ[by][new], errors):
                out.append((component[by][i], component[by][j]))
        two = np.flatnonzero(~alone)
        for s, t in zip(two[::2], two[1::2]):  # sides 1 and 2 of one pair; the codes of side 1 are the smaller ones
            span = slice(first[s], last[t])
            a, b = np.array([[0, last[s] - first[s]]]), np.array([[last[s] - first[s], last[t] - first[s]]])
            for i, j in node_pairs(codes[span], component[span], a, b, depth[first[s]:first[s] + 1],
                                   differ[first[s]:first[s] + 1], errors):
                out.append((component[span][i], component[span][j]))
        u, v = (np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else ((), ())))
        links = np.unique(np.stack([u, v], 1), axis=0)
        return pa.Table.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], schema=_LINKS)

    return run


# -- traversal as rows of a table -----------------------------------------------------------------

def _leaves(codes: DataFrame, depth: int, errors: int, tile: int) -> list[tuple[int, DataFrame]]:
    """Pairs of nodes, per depth, that a task can hold: ``trie``, ``a``, ``b`` (paths), ``differ``.

    Larger ones are split until none is left; the driver reads whether there is one.  Since fingerprints differ, a
    node is below any ``tile`` of 16 or more before its path ends."""
    def nodes(at: int, below: DataFrame | None) -> DataFrame:
        rows = codes.withColumn("node", _prefix(F.col("code"), at))
        if below is not None:  # only nodes that some pair still has
            above = _prefix(F.col("code"), at - LEVELS)
            rows = rows.join(below.withColumnsRenamed({"trie": "_trie", "node": "_node"}),
                             (F.col("trie") == F.col("_trie")) & (above == F.col("_node")), "left_semi")
        return rows.groupBy("trie", "node").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("least"),
                                                F.max("component").alias("most"))

    here = stored(nodes(depth, None).filter("n > 1"), "trie-nodes")
    pairs = here.select("trie", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("differ"),
                        F.col("n").alias("n_a"), F.col("n").alias("n_b"), (F.col("least") == F.col("most")).alias("one"))
    out = []
    while True:
        pairs = pairs.filter("NOT one")
        fits = F.greatest("n_a", "n_b") <= tile
        out.append((depth, pairs.filter(fits).drop("one")))
        large = pairs.filter(~fits)
        if depth + LEVELS > BITS or large.isEmpty():
            return out
        depth += LEVELS
        parents = large.select("trie", F.explode(F.array("a", "b")).alias("node")).distinct()
        here = stored(nodes(depth, parents), "trie-nodes")
        child = here.withColumn("above", F.shiftrightunsigned("node", LEVELS))
        left, right = (child.select([F.col(c).alias(f"{s}_{c}") for c in child.columns]) for s in ("x", "y"))
        split = (large.select("trie", "a", "b")
                 .join(left, (F.col("trie") == F.col("x_trie")) & (F.col("a") == F.col("x_above")))
                 .join(right, (F.col("trie") == F.col("y_trie")) & (F.col("b") == F.col("y_above"))))
        apart = F.bit_count(F.col("x_node").bitwiseXOR(F.col("y_node"))).cast("int")
        one = F.least("x_least", "y_least") == F.greatest("x_most", "y_most")
        split = split.select("trie", F.col("x_node").alias("a"), F.col("y_node").alias("b"), apart.alias("differ"),
                             F.col("x_n").alias("n_a"), F.col("y_n").alias("n_b"), one.alias("one"))
        pairs = stored(split.filter((F.col("a") <= F.col("b")) & (F.col("differ") <= errors)), "trie-pairs")


def _sides(codes: DataFrame, depth: int, leaves: DataFrame, tasks: int) -> DataFrame:
    """Fingerprints of the nodes of each pair, with the task that gets the pair."""
    alone = F.col("a") == F.col("b")
    pair = F.concat_ws("-", F.lit(str(depth)), "trie", "a", "b")
    task = F.when(alone, F.concat_ws("-", F.lit(str(depth)), "trie", F.pmod(F.xxhash64("a"), F.lit(tasks)))).otherwise(
        F.concat_ws("-", pair, F.lit("pair")))
    sides = F.when(alone, F.array(F.struct(F.col("a").alias("path"), F.lit(0).alias("side")))).otherwise(F.array(
        F.struct(F.col("a").alias("path"), F.lit(1).alias("side")), F.struct(F.col("b").alias("path"), F.lit(2).alias("side"))))
    pairs = leaves.select(F.col("trie").alias("_trie"), task.alias("task"), F.xxhash64("trie", "a", "b").alias("node"), "differ",
                          F.explode(sides).alias("s"))
    pairs = pairs.select("_trie", "task", "node", "differ", F.col("s.path").alias("path"), F.col("s.side").alias("side"))
    rows = codes.withColumn("path_here", _prefix(F.col("code"), depth))
    return rows.join(pairs, (F.col("trie") == F.col("_trie")) & (F.col("path_here") == F.col("path"))).select(
        "task", "node", "side", "code", "component", F.lit(depth).alias("depth"), "differ")


def linked_fingerprints(prints: DataFrame, errors: int = ERRORS, tile: int = TILE) -> DataFrame:
    """``print`` and ``group`` (the smallest print, as a signed number, that links reach) of distinct prints
    (column ``print``, longs; stored, since it is read several times).  Prints without a link may be missing."""
    n = prints.count()
    depth, tries = orders(n, errors)
    split = F.explode(F.array(*[F.struct(F.lit(i).alias("trie"), _reordered(F.col("print"), o).alias("code"))
                                for i, o in enumerate(tries)])).alias("t")
    codes = prints.select("print", split).select("print", "t.trie", "t.code")
    # Codes ascend as unsigned numbers; a range shuffle deals them by trie and code, so no range is large.
    unsigned = F.col("code").bitwiseXOR(F.lit(-(1 << 63)))
    ranged = codes.select("trie", "print", unsigned.alias("at")).repartitionByRange("trie", "at").sortWithinPartitions("trie", "at")
    near = connected(ranged.select("trie", "print").mapInArrow(_neighbours(errors), "u long, v long"), "simhash-near")
    near = stored(near.select(F.col("node").alias("_print"), F.col("component").alias("_group")), "simhash-groups")
    named = stored(prints.join(near, F.col("print") == F.col("_print"), "left").select(
        "print", F.coalesce("_group", "print").alias("component")), "simhash-named")
    codes = stored(named.select("component", split).select("component", "t.trie", "t.code"), "simhash-codes")
    tasks = max(1, n // TASK)
    work = None
    for at, leaves in _leaves(codes, depth, errors, tile):
        sides = _sides(codes, at, leaves, tasks)
        work = sides if work is None else work.union(sides)
    links = work.groupBy("task").applyInArrow(_traversed(errors), "u long, v long")
    groups = connected(links, "simhash-links").withColumnsRenamed({"node": "_node", "component": "group"})
    return named.join(groups, F.col("component") == F.col("_node"), "left").select(
        "print", F.coalesce("group", "component").alias("group"))


def near_duplicates(docs: DataFrame, width: int = WORDS, errors: int = ERRORS, tile: int = TILE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that links reach, for every row.

    Null and empty texts, and texts without words, have fingerprint zero and link like any other.  A row
    without an id has no component and links nothing.  Rows of one id are one document: all their fingerprints are linked.
    Rows that repeat give a row each.  Only ``doc_id`` and ``text`` are read, so other columns may have any name."""
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = stored(texts.mapInArrow(_fingerprints(width), "doc_id long, print long"), "simhash-rows")
    named = rows.filter("doc_id IS NOT NULL")
    prints = stored(named.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-prints")
    groups = stored(linked_fingerprints(prints.select("print"), errors, tile), "simhash-components")
    # Ids with several fingerprints link what these belong to.
    twice = named.groupBy("doc_id").agg(F.min("print").alias("u"), F.max("print").alias("v")).filter("u <> v")
    several = named.join(twice.select(F.col("doc_id").alias("_id"), "u"), F.col("doc_id") == F.col("_id")).select("print", "u")
    of = groups.withColumnsRenamed({"print": "_print", "group": "_group"})
    several = several.join(of, F.col("print") == F.col("_print")).select("u", F.col("_group").alias("v")).join(
        of, F.col("u") == F.col("_print")).select(F.col("_group").alias("u"), "v")
    same = connected(several, "simhash-ids").select(F.col("node").alias("_node"), F.col("component").alias("_all"))
    whole = groups.join(same, F.col("group") == F.col("_node"), "left").select("print", F.coalesce("_all", "group").alias("group"))
    whole = stored(whole.join(prints.withColumnRenamed("print", "_print"), F.col("print") == F.col("_print")).select(
        "print", "group", "first"), "simhash-groups")
    least = whole.groupBy("group").agg(F.min("first").alias("component_id")).withColumnRenamed("group", "_group")
    parts = whole.join(least, F.col("group") == F.col("_group")).select("print", "component_id")
    out = spread_join(rows, parts, ["print"], "doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
