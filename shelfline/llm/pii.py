"""Personal data in whole texts: generated candidates, scored by boosted trees, in DataFrame operations only.

Four base kinds (email, ip, card, phone) are found by patterns with checks and always stay.  Two more
generators propose spans with high recall, overlapping the base ones or not: runs of letters and digits
(keys, tokens, hashes) and groups of digits (numbers written without a plus sign).  A candidate is described
by coarse features of its format and of the characters before it.  Candidates of strict formats are the
positives that training has; all other candidates are negatives.  Training sees only counts per
combination of features (a table of at most ``CELLS`` rows, whatever the corpus), from the documents of one half; the
other half sets the score from which candidates are precise enough to be redacted.

Patterns start only where a match can start, and use possessive repetition, so that long runs cost
linear time and no stack.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import whole_text, with_plain_names
from shelfline.llm.quality_rules import let

# Kinds in the order of the contract.  A match may begin where the last one ended (\G) or where no run of its characters is under way.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "secret": r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{12,}+",
    "number": r"(?<![0-9A-Za-z+])(?<!\+[0-9]{1,3}[\x20().-]{0,2})\(?[0-9]{2,}+(?:[\x20().-]{1,2}[0-9]++){1,6}+",
}
# Texts without this cannot hold a match; a cheap test for most texts.
NEEDS = {"email": "@", "phone": "+"}
KINDS = [*BASE, *MORE]
CONTEXT = 24
# Feature -> number of values.
FEATURES = {"kind": 2, "digits": 5, "length": 6, "case": 4, "keyword": 2, "joined": 2, "runs": 3, "separator": 3}
CELLS = math.prod(FEATURES.values())
ROUNDS, RATE, PULL = 30, 0.3, 1.0
PRECISION, LEAST_EVIDENCE = 0.95, 5
BLOCK = 256


def located(text: Column, pattern: str, keep_context: bool = False) -> Column:
    """Matches of a pattern as structs of ``start``, ``end`` (code points, end exclusive), ``match``, and the characters before.

    Splitting and extracting walk the same matches, so positions are sums of lengths.  Sums go by blocks, which
    keeps texts with very many matches affordable."""
    def add(array):
        return F.aggregate(array, F.lit(0), lambda a, x: a + x)

    def build(matches):
        def with_gaps(gaps):
            def with_steps(steps):
                def with_blocks(blocks):
                    def one(match, i):
                        block = F.floor(i / BLOCK).cast("int")
                        start = (add(F.slice(blocks, F.lit(1), block)) + add(F.slice(steps, block * BLOCK + 1, i % BLOCK))
                                 + F.length(F.get(gaps, i)))
                        fields = [start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match")]
                        if keep_context:
                            fields.append(F.lower(F.right(F.get(gaps, i), F.lit(CONTEXT))).alias("before"))
                        return F.struct(*fields)
                    return F.transform(matches, one)
                sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / BLOCK).cast("int")),
                                   lambda b: add(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
                return let(sums, with_blocks)
            return let(F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(gaps, i))), with_steps)
        return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), with_gaps))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), build)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":  # no part above 255, leading zeros allowed
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of structs ``start``, ``end``, ``rank`` (of the kind) of the valid matches of every base kind, sorted."""
    def of(rank, kind):
        spans = located(text, BASE[kind])
        if kind in NEEDS:
            spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans)
        valid = F.filter(spans, lambda s: _valid(kind, s["match"]))
        plain = F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))
        return F.coalesce(plain, F.array().cast("array<struct<start:int,rank:int,end:int>>"))

    return F.sort_array(F.concat(*[of(rank, kind) for rank, kind in enumerate(BASE)]))


def _features(kind: int, s: Column) -> list[Column]:
    match, before = s["match"], s["before"]
    n, digits = F.length(match), F.length(_digits(match))
    upper, lower = match.rlike("[A-Z]").cast("int"), match.rlike("[a-z]").cast("int")
    length = sum((n >= cut).cast("int") for cut in (16, 20, 21, 32, 40))
    runs = F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)))
    separator = F.when(match.rlike(r"^[^.\x20()-]*$"), 0).when(match.rlike(r"^[0-9.]*$"), 1).otherwise(2)
    keyword = before.rlike("pass|pwd|secret|token|key|call|phone|tel|contact|ssn|account|card|mobile|fax")
    return [F.lit(kind), F.floor(4 * digits / n).cast("int"), length, upper + 2 * lower, keyword.cast("int"),
            before.rlike("[=:\"']\\s?$").cast("int"), F.least(F.floor(runs / 2), F.lit(2)).cast("int"), separator]


def _strict(kind: str, s: Column) -> Column:
    """Formats that are personal or secret beyond doubt: the positives of training."""
    match = s["match"]
    if kind == "secret":
        return (match.rlike("^A[KS]IA[A-Z0-9]{16}$") | match.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$")
                | s["before"].rlike("(?:password|passwd|pwd|secret|token|api.?key)[\"']?\\s?[=:]\\s?[\"']?$"))
    return match.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$") | match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")


def candidates(text: Column) -> Column:
    """Array of structs ``start``, ``rank``, ``end``, ``x`` (features), ``strict`` of the two wide generators."""
    def of(k, kind):
        spans = F.when(text.rlike("[0-9]"), located(text, MORE[kind], keep_context=True))
        described = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(BASE) + k).alias("rank"), s["end"].alias("end"),
            F.array(*_features(k, s)).alias("x"), _strict(kind, s).alias("strict")))
        return F.coalesce(described, F.array().cast("array<struct<start:int,rank:int,end:int,x:array<int>,strict:boolean>>"))

    return F.concat(*[of(k, kind) for k, kind in enumerate(MORE)])


# -- boosted trees over cells -------------------------------------------------------------------

class Trees:
    """Sum of trees of depth two: (feature, cut, (feature, cut, low, high), (feature, cut, low, high)); ``x < cut`` is low."""

    def __init__(self, bias: float = 0.0):
        self.bias, self.trees, self.threshold = bias, [], math.inf

    @staticmethod
    def _leaf(tree, x) -> float:
        feature, cut, low, high = tree
        feature, cut, low, high = low if x[feature] < cut else high
        return low if x[feature] < cut else high

    def margin(self, x) -> float:
        return self.bias + sum(self._leaf(t, x) for t in self.trees)

    def column(self, x: Column) -> Column:
        out = F.lit(self.bias)
        for feature, cut, low, high in self.trees:
            sides = [F.when(F.get(x, F.lit(f)) < c, F.lit(a)).otherwise(F.lit(b)) for f, c, a, b in (low, high)]
            out = out + F.when(F.get(x, F.lit(feature)) < cut, sides[0]).otherwise(sides[1])
        return out


def _best_split(x, rows, gradient, hessian):
    """(gain, feature, cut, value below, value above) of one node."""
    def value(g, h):
        return -g / (h + PULL)

    total_g, total_h = sum(gradient[i] for i in rows), sum(hessian[i] for i in rows)
    best = (0.0, 0, 0, value(total_g, total_h), value(total_g, total_h))
    for feature, values in enumerate(FEATURES.values()):
        for cut in range(1, values):
            g = sum(gradient[i] for i in rows if x[i][feature] < cut)
            h = sum(hessian[i] for i in rows if x[i][feature] < cut)
            gain = g * g / (h + PULL) + (total_g - g) ** 2 / (total_h - h + PULL) - total_g ** 2 / (total_h + PULL)
            if gain > best[0] + 1e-9:
                best = (gain, feature, cut, value(g, h), value(total_g - g, total_h - h))
    return best


def fit(cells: list[tuple[tuple[int, ...], int, int, int]]) -> Trees:
    """``cells``: features, which half (0 trains, 1 calibrates), candidates, positives.  Newton boosting of the log loss."""
    seen = sorted((c for c in cells if c[1] == 0), key=lambda c: c[0])
    n, ones = sum(c[2] for c in seen), sum(c[3] for c in seen)
    if not 0 < ones < n:
        return Trees()
    model = Trees(math.log(ones / (n - ones)))
    x = [c[0] for c in seen]
    margin = [model.bias] * len(seen)
    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, m)))) for m in margin]
        gradient = [c[2] * q - c[3] for c, q in zip(seen, p)]
        hessian = [c[2] * q * (1 - q) for c, q in zip(seen, p)]
        everything = range(len(seen))
        _, feature, cut, _, _ = _best_split(x, everything, gradient, hessian)
        sides = []
        for rows in ([i for i in everything if seen[i][0][feature] < cut], [i for i in everything if seen[i][0][feature] >= cut]):
            _, f, c, low, high = _best_split(x, rows, gradient, hessian)
            sides.append((f, c, RATE * low, RATE * high))
        model.trees.append((feature, cut, *sides))
        margin = [m + model._leaf(model.trees[-1], c[0]) for m, c in zip(margin, seen)]
    # Calibration: going down from the highest margin, the lowest one at which all above is still precise; the threshold
    # lies half way to the next, since the half that calibrates does not show every combination.
    held, ones = 0, 0
    other = sorted(((model.margin(c[0]), c[2], c[3]) for c in cells if c[1] == 1), reverse=True)
    for i, (m, count, positive) in enumerate(other):
        held, ones = held + count, ones + positive
        if i + 1 < len(other) and other[i + 1][0] == m:
            continue
        if held >= LEAST_EVIDENCE and ones / held >= PRECISION and m > 0:
            below = other[i + 1][0] if i + 1 < len(other) else 0.0
            model.threshold = (m + max(0.0, below)) / 2
    return model


def train(docs: DataFrame) -> Trees:
    """Trees for the wide generators, from all candidates of all documents, counted per cell."""
    half = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2, F.lit(0))
    found = docs.select(half.cast("int").alias("half"), F.explode(candidates(whole_text())).alias("c"))
    cells = found.groupBy("c.x", "half").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.strict").cast("long")).alias("ones"))
    return fit([(tuple(r["x"]), r["half"], r["n"], r["ones"]) for r in cells.collect()])  # 2 * CELLS rows at most


def all_spans(text: Column, model: Trees) -> Column:
    """Base spans and the accepted candidates, sorted by start and kind."""
    if not model.trees or model.threshold == math.inf:
        return base_spans(text)
    accepted = F.filter(candidates(text), lambda c: model.column(c["x"]) >= F.lit(model.threshold))
    plain = F.transform(accepted, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end")))
    return F.sort_array(F.concat(base_spans(text), plain))


def with_spans(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``docs`` with ``_spans``; trains on ``docs`` unless a model is given."""
    model = model or train(docs)
    return docs.withColumn("_spans", all_spans(whole_text(), model))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def spans_report(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256`` and ``spans`` of every row.

    Null and empty texts have no spans.  Ids may be null or repeat.  Without candidates of both classes
    nothing is added to the base spans.  Only ``doc_id`` and ``text`` are read.
    """
    rows = with_spans(docs.select("doc_id", "text"), model).select("doc_id", "_spans")
    base = F.filter("_spans", lambda s: s["rank"] < len(BASE))

    def count(rank):
        return F.size(F.filter("_spans", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def redacted(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``docs``, all columns, with every span of ``text`` replaced by its kind in brackets and ``n_chars``, if there, counted anew.

    Overlapping spans are replaced as one, named after the first.  A text without spans stays as it is, null
    included."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = whole_text()
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state, s):
        new = F.array(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.get(names, s["rank"]))
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), F.concat(state["parts"], new).alias("parts"))).otherwise(
            F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["parts"].alias("parts")))

    def finish(state):
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text)))

    return with_plain_names(docs, ("doc_id", "text", "n_chars"), lambda rows: _replaced(rows, model, start, step, finish))


def _replaced(docs: DataFrame, model: Trees | None, start: Column, step, finish) -> DataFrame:
    rows = with_spans(docs, model)
    new = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step, finish)).otherwise(F.col("text"))
    rows = rows.withColumn("text", new)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
