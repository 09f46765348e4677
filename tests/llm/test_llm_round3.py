"""Fingerprint links, hard negatives and periodic runs against plain versions, on small tables with odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from shelfline.llm import hard_negatives, periodic_runs, simhash_trie
from shelfline.llm.common import stored
from shelfline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, print string, _group long, component long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 120)
    texts = [None, "", " \t\n", "one", "One", "Two  words", "two words", base, base.upper(), base.replace("a", "b", 1), prose(2, 3000),
             "ha " * 13, "x\x1cy é ß İ \xa0 " * 9, "a b c " * 4 + "d", " ".join(["p q r s t u v"] * 2 + ["z"] + ["m n"] * 40)]
    out = [(i, t, None, "x", 1, i) for i, t in enumerate(texts)]
    return out + [out[7], (None, "no id", None, None, None, None), (None, base, None, None, None, None), (3, base, None, "y", 0, 0),
                  (-5, prose(9, 60), "en", "", 3, 3)]


# -- 11 -----------------------------------------------------------------------------------------

def plain_print(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(links, nodes):
    group = {n: n for n in nodes}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for u, v in links:
        u, v = find(u), find(v)
        group[max(u, v)] = min(u, v)
    return {n: find(n) for n in nodes}


def near_pairs(prints):
    return [(p, q) for i, p in enumerate(prints) for q in prints[:i] if (p ^ q).bit_count() <= 4]


def test_fingerprint_components(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = simhash_trie.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [plain_print(r[1]) for r in rows]
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(r[0]), f"{p:016x}") for r, p in zip(rows, prints))
    ids = [(r[0], p) for r, p in zip(rows, prints) if r[0] is not None]
    links = [(a, b) for a, p in ids for b, q in ids if (p ^ q).bit_count() <= 4]
    want = plain_groups(links, {a for a, _ in ids})
    assert all(r["component_id"] == want.get(r["doc_id"]) for r in got)
    assert want[3] == want[7] == want[4] and want[0] == want[1] == want[2] == 0
    assert simhash_trie.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile, node", [(simhash_trie.TILE, simhash_trie.NODE), (16, -1)])
def test_trie_join(spark, monkeypatch, tile, node):
    """Random prints, chains, a ball of near ones and many below one node; with small tiles nodes are split as
    rows of a table, and with small nodes there are more tries."""
    monkeypatch.setattr(simhash_trie, "NODE", node)
    rng = random.Random(5)
    ball, prints = rng.getrandbits(64), {0, (1 << 64) - 1}
    for _ in range(120):
        prints.add(p := rng.getrandbits(64))
        for _ in range(rng.randrange(5)):
            for _ in range(rng.randrange(7)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    for _ in range(150):
        p = ball
        for _ in range(rng.randrange(8)):
            p ^= 1 << rng.randrange(64)
        prints |= {p, ball >> 40 << 40 | rng.getrandbits(40)}
    prints = sorted(prints)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = stored(spark.createDataFrame([(s,) for s in signed.values()], "print long"), "prints")
    got = {r["print"]: r["group"] for r in simhash_trie.linked_fingerprints(frame, tile=tile).collect()}
    want = plain_groups([(signed[p], signed[q]) for p, q in near_pairs(prints)], signed.values())
    assert got == want and len(set(want.values())) < len(want)
    depth, tries = simhash_trie.orders(len(prints))
    assert (depth, len(tries)) == ((12, 5) if node > 0 else (32, 70))
    assert all(sorted(b for a, z in t for b in range(a, z)) == list(range(64)) for t in tries)


def test_node_pairs_link_components_only():
    codes = np.array([0, 1, 3, 1 << 63, (1 << 63) + 1], np.uint64)
    whole = np.array([[0, 5]])
    zero = np.array([0])

    def links(component):
        found = simhash_trie.node_pairs(codes, np.array(component), whole, whole, zero, zero, errors=1)
        return {tuple(sorted((int(i), int(j)))) for f in found for i, j in f.T}

    assert links([0, 1, 2, 3, 4]) == {(0, 1), (1, 2), (0, 3), (1, 4), (3, 4)}
    assert links([0, 0, 0, 3, 3]) == {(0, 3), (1, 4)}
    assert links([7] * 5) == set()


# -- 12 -----------------------------------------------------------------------------------------

def plain_mining(rows, positives=5, negatives=5):
    first = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        first[i] = min(first.get(i, (label, v)), (label, v))
    whole = {i: (label, [int(np.floor(256 * float(x))) for x in v]) for i, (label, v) in first.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % 100:
            continue
        ranked = sorted((max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(v, w)))), i, b) for i, (b, w) in whole.items()
                        if i != a and len(w) == len(v))
        ranked.sort(key=lambda r: (-r[0], r[1]))
        for score, p, _ in [r for r in ranked if r[2] == label][:positives]:
            inside = [r for r in ranked if r[2] != label and 80 * score <= 100 * r[0] <= 100 * score]
            out += [(a, p, k + 1, n, score, s) for k, (s, n, _) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    frame = frame.selectExpr("*", "'x' AS anchor", "1 AS key", "2 AS windows", "3 AS width", "true AS is_anchor").repartition(3)
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(frame, **options).collect())


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 64)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 2)
    monkeypatch.setattr(hard_negatives, "SCORES", 100)
    rng = random.Random(3)
    rows = [(i, rng.randrange(4), [rng.choice([-.5, .25, .3, .75]) for _ in range(4)]) for i in range(500)]  # many ties
    rows += [(None, 1, [1.0] * 4), (700, None, [1.0] * 4), (800, 1, None), (900, 1, [None, 1.0, 1.0, 1.0]),
             (901, 1, [float("nan")] * 4), (902, 1, [float("inf")] * 4), (1000, 1, []), (1001, 2, []), (1002, 1, []),
             (1100, 0, [1.0, 1.0]), (1101, 0, [1.0, 1.0]), (1102, 2, [.9, 1.0]), rows[0], (100, 3, [.3] * 4), (-100, 2, [.5] * 4)]
    want = plain_mining(rows)
    assert mined(spark, rows) == want and {r[0] for r in want} >= {0, 100, 200, -100, 1000, 1100}
    assert mined(spark, rows, positives=2, negatives=7) == plain_mining(rows, 2, 7)
    assert mined(spark, []) == []


def test_large_scores(spark):
    for size in (2.0 ** 25, 2.0 ** 40, 1e300):
        rows = [(100 * i if i < 2 else i, i % 2, [size, i + 1.0]) for i in range(9)]
        assert mined(spark, rows) == plain_mining(rows)


def test_keys_sort():
    rows = [(a, s, n, i) for a in (-1, 0, 5) for s in (-(1 << 63), -3, 0, (1 << 63) - 1) for n in (0, 1) for i in (-9, 4)]
    keys = hard_negatives.packed(*zip(*rows))
    assert list(hard_negatives.unpacked(keys)) == rows
    assert list(hard_negatives.unpacked(sorted(keys))) == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


# -- 13 -----------------------------------------------------------------------------------------

def plain_runs(words):
    ids = np.array([sorted(set(words)).index(w) for w in words], np.int64)
    least = {}
    for q in range(1, len(ids) // 2 + 1):
        equal = np.concatenate([[0], (ids[:-q] == ids[q:]).astype(int), [0]])
        for s, e in np.flatnonzero(np.diff(equal)).reshape(-1, 2).tolist():
            if e - s + q >= max(12, 2 * q):
                least.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in least.items())


def plain_row(doc_id, text, plant):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None,) * 3
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_runs_of_word_ids(monkeypatch):
    rng = random.Random(1)
    for trial in range(500):
        monkeypatch.setattr(periodic_runs, "SLICE", rng.choice([7, 1 << 20]))
        ids = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(200))]
        if trial % 5 == 1:
            ids = (ids[:rng.randrange(1, 40)] * 200)[:200]
        if trial % 5 == 2:
            ids = (ids + (ids[:9] * 40)[:rng.randrange(90)] + ids) * rng.randrange(1, 4)
        if trial % 5 == 3:  # a Fibonacci word: as many runs as there can be, one inside another
            ids, more = [0], [0, 1]
            while len(more) < 300:
                ids, more = more, more + ids
            ids = more[rng.randrange(50):]
        if trial % 5 == 4 and ids:
            ids = ids * 4
            ids[rng.randrange(len(ids))] = 99
        assert periodic_runs.runs_of(np.array(ids, np.int64)) == plain_runs(ids)


def test_grammar_derives_its_text():
    ids = np.array([0, 1, 0, 1, 0, 1, 1, 1, 1, 1, 2, 0, 1, 2, 0, 1], np.int64)
    for lo, mid, hi, places in zip(*periodic_runs.grammar(ids)):
        assert lo < mid < hi and places[0] == lo
        assert all((ids[p:p + hi - lo] == ids[lo:hi]).all() for p in places)


@pytest.mark.parametrize("plant", [False, True])
def test_periodic_runs(spark, rows, plant):
    rows = rows + [(1000 + i, prose(i, 40 + 7 * i), None, None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = periodic_runs.periodic_runs(docs, digests_only=True, plant=plant).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain_row(r[0], r[1], plant)) for r in rows)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_periodic_runs_give_texts(spark):
    docs = spark.createDataFrame([(1, "a b " * 8 + "c")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs).first()
    assert row["runs"] == [[0, 16, 2]] and bytes(row["collapsed"]) == b"a b c"


# -- queries ------------------------------------------------------------------------------------

def test_queries_cover_their_tables(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op13_periodic_runs"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in found} == docs.keys() and len(found) == len(docs)
    short = [i for i, t in docs.items() if len(t or "") < 6000]
    want = {i: plain_row(i, docs[i], True) for i in short}
    assert all(tuple(r) == want[r["doc_id"]] for r in found if r["doc_id"] in want)
    prints = {i: plain_print(t) for i, t in docs.items()}
    groups = plain_groups([(i, j) for i, p in prints.items() for j, q in prints.items() if (p ^ q).bit_count() <= 4], docs)
    got = QUERIES["op11_simhash"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(i, f"{prints[i]:016x}", groups[i]) for i in docs}


# -- words merged together -------------------------------------------------------------------------

def test_words_merged_together_and_texts_by_dictionary():
    """Rank arrays as rows of a matrix give the merges of the single ones; texts encoded through a dictionary of their words, too."""
    import public_tokenizers
    import pyarrow as pa

    from shelfline.llm import packing, word_bpe

    bpe, encoded = word_bpe.encoder(public_tokenizers.path(word_bpe.VOCABULARY))
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("etaoinshrdlu" if rng.random() < .8 else "xyz0!é")[0] for _ in range(rng.randrange(1, 24))) for _ in range(3000)})
    words = [w for w in words if w.isascii()] + ["a", "the", "a" * 24]
    got = [np.frombuffer(x, "<i4").tolist() for x in bpe.merge_many(words)]
    assert got == [[bpe.ids[t] for t in bpe.merge(w)] for w in words] and bpe.merge_many([]) == []
    texts = ["", " ", "a\x1cb \x1f c", "  lead\t\ntrail  ", "x" * 300 + " é你好 ß'll " * 50, "<|endoftext|> 'll", " ".join(words)]
    rows = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = packing._encoded(rows.column("text"), bpe, encoded, "<u2")
    assert [np.frombuffer(x, "<u2").tolist() for x in whole] == [bpe.encode(t) for t in texts]
    assert packing._encoded(rows.column("text").slice(3), bpe, encoded, "<u2") == whole[3:]
    assert [len(b) for b in packing._slices(rows)] == [7] and [len(b) for b in packing._gathered([rows, rows.slice(2)])] == [12]


def test_stages_keep_columns_of_any_name(spark, monkeypatch):
    """Columns called as the stages call their own; with ids sent to the texts, and with a shuffle."""
    import corpus_pipeline

    from shelfline.llm import common

    names = ["_x", "_score", "_id", "_print", "_sha", "_dropped", "_spans", "_keep", "_c", "extra2", "kept"]
    base = prose(1, 120)
    texts = [base, base, base + "  ", base.replace(base.split()[60], "other", 1), prose(2, 80), None, "mail a.b@example.com now " + prose(3, 40)]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    from shelfline.llm import exact_dedup, pii, quality_classifier, shingle_join

    for most in (common.MOST_BROADCAST, 0):
        monkeypatch.setattr(common, "MOST_BROADCAST", most)
        for stage, ids in ((exact_dedup.one_per_text, {0, 2, 3, 4, 5, 6}), (shingle_join.one_per_component, {0, 4, 5, 6}), (pii.redacted, set(range(7))),
                           (lambda d: quality_classifier.accepted(d, labels), None)):
            out = stage(docs)
            found = {r["doc_id"]: r for r in out.collect()}
            assert out.columns == docs.columns and (ids is None or found.keys() == ids)
            assert all(r[n] == f"{n}{i}" for i, r in found.items() for n in names)
    assert "[EMAIL]" in found_text(pii.redacted(docs), 6)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "personal_data", "packing"]


def found_text(df, i):
    return {r["doc_id"]: r["text"] for r in df.collect()}[i]


def test_packing_leaves_nothing_in_its_workers(spark):
    import public_tokenizers

    from shelfline.llm import packing
    docs = spark.createDataFrame([(i, f"word{i} others, and more{i}", "a") for i in range(40)], "doc_id long, text string, source string")
    packing.tokenize(docs.repartition(4), public_tokenizers.path(packing.VOCABULARY)).count()

    def held(iterator):
        import pandas as pd

        from shelfline.llm import word_bpe
        for _ in iterator:
            yield pd.DataFrame({"n": [sum(len(c) + len(b._words) for b, c in word_bpe._ENCODERS.values())]})

    assert {r.n for r in spark.range(64).repartition(16).mapInPandas(held, "n long").collect()} == {0}


def test_packing_ids_of_slices_equal_the_library(spark):
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from shelfline.llm import packing
    from shelfline.llm.word_bpe import encoder
    path = public_tokenizers.path(packing.VOCABULARY)
    texts = ["", "Two words, Two WORDS", " \t", "caf\xe9 na\xefve don't x2 <|endoftext|> \u6f22\u5b57 a\x1cb", "z" * 300, "end."]
    library, (bpe, known) = Tokenizer.from_file(path), encoder(path, packing.CACHE_CHUNKS)
    for part in (pa.array(texts), pa.array(texts).slice(1, 4), pa.array(texts[:1]), pa.array([], pa.string())):
        got = packing._encoded(part, bpe, known, "<u2")
        assert [list(memoryview(g).cast("H")) for g in got] == [library.encode(t, add_special_tokens=False).ids for t in part.to_pylist()]
    known.empty()
    bpe.forget()


# -- 7: keys by which sets meet -------------------------------------------------------------------

def test_linked_sets_have_a_key_in_common():
    """Sets at the very edge of a link, of any size, with any elements frequent; also where all elements fall into one part."""
    from shelfline.llm import shingle_join as J
    rng = np.random.default_rng(5)
    tables = [lambda x: np.zeros(len(x), bool), lambda x: x % np.uint64(3) != 0, lambda x: np.ones(len(x), bool)]
    for link in ((80, 100), (50, 100), (100, 100)):
        a, b = link
        for trial in range(700):
            n = int(np.exp(rng.uniform(0, 6.5))) + 1
            top = np.uint64(1) << np.uint64(40 if trial % 5 == 0 else 63)  # small hashes: one part holds all
            pool = np.unique(rng.integers(0, top, 3 * n, dtype=np.uint64))
            rng.shuffle(pool)
            gone = rng.integers(0, n * (b - a) // b + 1)
            more = ((n - gone) * b - a * n) // a
            x, y = np.sort(pool[:n]), np.sort(pool[gone:n + more])
            both = len(np.intersect1d(x, y))
            assert b * both >= a * (len(x) + len(y) - both)
            for late in tables:
                assert np.intersect1d(J.keys_of(x, late(x), link), J.keys_of(y, late(y), link)).size, (link, n, gone, more)


def test_texts_that_share_common_phrases_do_not_become_one_cluster(spark, monkeypatch):
    """Every text has phrases of a small stock, so each shares some shingles with many others; only copies meet."""
    from shelfline.llm import shingle_join as J
    rng = random.Random(8)
    stock = [" ".join(f"p{k}w{i}" for i in range(5)) for k in range(400)]
    texts = [" ".join(rng.choice(stock) if rng.random() < 0.6 else f"own{d}x{i}" for i in range(40)) for d in range(300)]
    texts += [t + f" tail{k}" for k, t in enumerate(texts[:20])]
    found, real = {}, J.connected

    def counted(edges, label):
        out = stored(real(edges, label), "counted")
        found[label] = out.groupBy("component").count().agg({"count": "max"}).first()[0]
        return out

    monkeypatch.setattr(J, "connected", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in J.similar_components(docs).collect()}
    assert got == {i: i % 300 if i >= 300 else i for i in range(320)}
    assert found["clusters"] <= 8


# -- 9: words as arrays ---------------------------------------------------------------------------

@pytest.mark.parametrize("most", [0, 5, 900, 10**6])
def test_chunks_encoded_as_arrays_equal_single_ones(most):
    """Every visible Latin-1 character and what the array form leaves to the single one, with stores that overflow."""
    import public_tokenizers
    import pyarrow as pa

    from shelfline.llm import word_bpe
    bpe = word_bpe.WordBPE(public_tokenizers.path(word_bpe.VOCABULARY))
    bpe.chunk_arrays, bpe.word_arrays = word_bpe.IdArrays(most), word_bpe.IdArrays(most)
    known, plain = word_bpe.Chunks(bpe.chunk_ids), word_bpe.WordBPE(public_tokenizers.path(word_bpe.VOCABULARY))
    rng, letters = random.Random(4), [chr(c) for c in [*range(33, 127), *range(161, 256)]]
    odd = ["don't", "'ll", "<|endoftext|>", "a<|b", "<", "|x", "漢字", "a\x1cb", "\x7f", "\xa0", "\x80\x9f", "İx", "é", "z" * 300, "\xc9" * 40, "", "\xd7\xf7\xb5\xdf"]
    for _ in range(3):
        chunks = list(dict.fromkeys(odd + letters + ["".join(rng.choice(letters if rng.random() < 0.4 else "etaoinSHR,.1\xe9\xc8") for _ in range(rng.randrange(1, 30)))
                                                     for _ in range(700)]))
        rng.shuffle(chunks)
        got = bpe.ids_of_chunks(pa.array(chunks, pa.large_string()), known).to_pylist()
        assert got == [plain.chunk_ids(c) if c else b"" for c in chunks]
        assert len(bpe.chunk_arrays) <= max(most, 0) and len(bpe.word_arrays) <= max(most, 0)
    assert bpe.ids_of_chunks(pa.array([], pa.large_string()), known).to_pylist() == []
    bpe.forget()
    assert len(bpe.chunk_arrays) == len(bpe.word_arrays) == 0
