"""Quality rules whose thresholds follow the corpus, per language and source, in DataFrame operations only.

Every document gets counts.  Its rates go into quantile sketches: counts per bin, which merge by adding.  Bins are
of fixed width up to a value, then of a width that doubles whenever the value does, so they have no top.  Sketches are kept per (language, source) and merged to languages and to the corpus for
groups that are too small to judge by.  A document is dropped where a rate lies beyond the fence of its
group, the quartile plus several interquartile ranges plus a slack, so documents that are usual for
their group stay whatever the group looks like.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.common import SPACE_CLASS, SPACES, spread_join, stored, whole_text

WINDOW_WORDS = 5
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
# Width of bins below TOP; from there to twice TOP it is doubled, and so on, so a bin is never wider than a 2,000th of its values.
BIN, TOP = 5, 20_000
# Documents that a group needs for thresholds of its own.
LEAST_GROUP = 200
FENCE = 3
# Rate (per thousand): slack above the upper fence, below the lower one (None: no lower fence).
RATES = {"symbol_rate": (150, None), "line_rate": (400, None), "length_rate": (5000, 2500)}
# A rate of few events says nothing.
LEAST_EVENTS = {"symbol_rate": ("n_symbols", 5), "line_rate": ("n_dup_lines", 5)}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def _covered(positions: Column, width: int) -> Column:
    """Words under windows that start at the given ascending positions."""
    steps = F.transform(positions, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(positions, i + 1) - p, F.lit(width))))
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def repeated_words(found: Column, width: int = WINDOW_WORDS) -> Column:
    """Words inside windows that occur more than once in the array of words; linear but for two sorts.

    Windows are compared by 64-bit hashes of the hashes of their words."""
    def positions(windows: Column) -> Column:
        def again(x, i):
            return F.coalesce((F.get(windows, i - 1)["key"] == x["key"]) | (F.get(windows, i + 1)["key"] == x["key"]),
                              F.get(windows, i - 1)["key"] == x["key"], F.get(windows, i + 1)["key"] == x["key"], F.lit(False))
        return F.array_sort(F.transform(F.filter(windows, again), lambda x: x["at"]))

    def windows(hashes: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(0), F.size(hashes) - width), lambda i: F.struct(
            F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]).alias("key"), i.alias("at")))
        return F.sort_array(keys)

    counted = let(F.transform(found, lambda w: F.xxhash64(w)), lambda h: let(windows(h), lambda w: let(
        positions(w), lambda p: _covered(p, width))))
    return F.when(F.size(found) >= width, counted).otherwise(F.lit(0))


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the counts of the contract, and the rates per thousand."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", whole_text().alias("_text"))
    rows = rows.withColumn("_words", words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    rows = rows.withColumn("_lines", lines)
    rows = rows.select(
        "doc_id", "lang", "source", F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"), F.size("_lines").alias("_n_lines"))

    def rate(part, whole):
        return F.expr(f"1000 * {part} DIV greatest({whole}, 1)")

    return rows.withColumns({"symbol_rate": rate("n_symbols", "n_words"), "line_rate": rate("n_dup_lines", "_n_lines"),
                             "length_rate": rate("word_chars", "n_words")}).drop("_n_lines")


def bin_of(rate: Column) -> Column:
    """Lower end of the rate's bin."""
    # The binary digits of a whole number say how often it doubles TOP, without rounding.
    doubled = F.when(rate < TOP, F.lit(0)).otherwise(F.length(F.bin((rate / TOP).cast("long"))))
    return rate - rate % (BIN * F.pow(F.lit(2.0), doubled)).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """Bins of every rate: ``lang``, ``source``, ``rate``, ``bin``, ``n``; of documents with enough words only."""
    entries = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), bin_of(F.col(r)).alias("bin")) for r in RATES])).alias("e")
    return rows.filter(F.col("n_words") >= LEAST_WORDS).select("lang", "source", entries).groupBy(
        "lang", "source", "e.rate", "e.bin").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*by, "rate", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """One row per group of at least ``LEAST_GROUP`` documents: its size and the two ends of every rate."""
    order = Window.partitionBy(*by, "rate").orderBy("bin")
    whole = Window.partitionBy(*by, "rate")
    ranked = sketch.withColumns({"upto": F.sum("n").over(order), "docs": F.sum("n").over(whole)})

    def quartile(k):
        return F.min(F.when(4 * F.col("upto") >= k * F.col("docs"), F.col("bin")))

    ends = ranked.groupBy(*by, "rate").agg(F.max("docs").alias("docs"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    spread = FENCE * (F.col("q3") - F.col("q1"))
    picks = [F.max("docs").alias("docs")]
    for rate, (above, below) in RATES.items():
        here = F.col("rate") == rate
        picks.append(F.max(F.when(here, F.col("q3") + spread + above)).alias(f"{rate}_most"))
        if below is not None:
            picks.append(F.max(F.when(here, F.col("q1") - spread - below)).alias(f"{rate}_least"))
    return ends.groupBy(*by).agg(*picks).filter(F.col("docs") >= LEAST_GROUP).drop("docs")


def thresholds(sketch: DataFrame) -> DataFrame:
    """Fences of every (language, source) that occurs: its own, or its language's, or the corpus's; null if none."""
    names = [f"{r}_most" for r in RATES] + [f"{r}_least" for r, (_, below) in RATES.items() if below is not None]
    groups = sketch.select("lang", "source").distinct()
    own = fences(sketch, "lang", "source").withColumnsRenamed({n: f"own_{n}" for n in names} | {"lang": "_l", "source": "_s"})
    lang = fences(merged(sketch, "lang"), "lang").withColumnsRenamed({n: f"lang_{n}" for n in names} | {"lang": "_ll"})
    corpus = fences(merged(sketch.withColumn("all", F.lit(1)), "all"), "all").withColumnsRenamed({n: f"all_{n}" for n in names})
    found = groups.withColumn("_one", F.lit(1))
    found = found.join(own, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    found = found.join(lang, F.col("lang").eqNullSafe(F.col("_ll")), "left")
    found = found.join(corpus, F.col("_one") == F.col("all"), "left")
    return found.select("lang", "source", *[F.coalesce(f"own_{n}", f"lang_{n}", f"all_{n}").alias(n) for n in names])


def judged(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of every row of ``docs``: the counts of the contract, ``base_failed``, ``kept``.

    Null and empty texts have no words and fail.  Null languages and sources are groups like any other.
    A corpus too small for any sketch is judged by the base rules alone.
    """
    rows = stored(counts(docs), "counts")
    ends = stored(thresholds(sketches(rows)), "thresholds")
    out = spread_join(rows, ends, ["lang", "source"], "doc_id")
    beyond = F.lit(False)
    for rate, (_, below) in RATES.items():
        far = F.col(rate) > F.col(f"{rate}_most")
        if below is not None:
            far = far | (F.col(rate) < F.col(f"{rate}_least"))
        if rate in LEAST_EVENTS:
            events, least = LEAST_EVENTS[rate]
            far = far & (F.col(events) >= least)
        beyond = beyond | F.coalesce(far, F.lit(False))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & ~beyond).alias("kept"))


def oracle() -> str:
    """The same in DuckDB SQL, made from the same parameters."""
    fence = []
    for rate, (above, below) in RATES.items():
        fence.append(f"max(CASE WHEN rate = '{rate}' THEN q3 + {FENCE} * (q3 - q1) + {above} END) AS {rate}_most")
        if below is not None:
            fence.append(f"max(CASE WHEN rate = '{rate}' THEN q1 - {FENCE} * (q3 - q1) - {below} END) AS {rate}_least")
    names = [f.rpartition(" AS ")[2] for f in fence]
    far = []
    for rate, (_, below) in RATES.items():
        test = f"least({rate}, {TOP}) > {rate}_most"
        if below is not None:
            test = f"({test} OR least({rate}, {TOP}) < {rate}_least)"
        if rate in LEAST_EVENTS:
            events, least = LEAST_EVENTS[rate]
            test = f"({test} AND {events} >= {least})"
        far.append(f"coalesce({test}, false)")
    bins = " UNION ALL ".join(
        f"SELECT lang, source, '{r}' AS rate, least({r}, {TOP}) - least({r}, {TOP}) % {BIN} AS bin FROM c WHERE n_words >= {LEAST_WORDS}"
        for r in RATES)

    def level(name, keys):
        by = "".join(f"{k}, " for k in keys)
        return f"""
{name}_r AS (SELECT {by}rate, bin, n, sum(n) OVER (PARTITION BY {by}rate ORDER BY bin) AS upto,
  sum(n) OVER (PARTITION BY {by}rate) AS docs FROM (SELECT {by}rate, bin, sum(n) AS n FROM k GROUP BY {by}rate, bin)),
{name}_q AS (SELECT {by}rate, max(docs) AS docs, min(CASE WHEN 4 * upto >= docs THEN bin END) AS q1,
  min(CASE WHEN 4 * upto >= 3 * docs THEN bin END) AS q3 FROM {name}_r GROUP BY {by}rate),
{name} AS (SELECT {by}{", ".join(fence)} FROM {name}_q {"GROUP BY " + ", ".join(keys) if keys else ""} HAVING max(docs) >= {LEAST_GROUP})"""

    picked = ", ".join(f"coalesce(own.{n}, tongue.{n}, corpus.{n}) AS {n}" for n in names)
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
  regexp_extract_all(t, '[^\\n]*[^\\x20\\x09-\\x0D][^\\n]*') AS ls FROM d),
i AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW_WORDS - 2})) AS pos FROM w WHERE len(ws) >= {WINDOW_WORDS}),
g AS (SELECT doc_id, pos, list_slice(ws, pos, pos + {WINDOW_WORDS - 1}) AS gram FROM i),
m AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM g),
v AS (SELECT DISTINCT doc_id, pos + o AS place FROM m, (SELECT unnest(range({WINDOW_WORDS})) AS o) WHERE times > 1),
r AS (SELECT doc_id, count(*) AS n_repeat_words FROM v GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
c AS (SELECT *, 1000 * n_symbols // greatest(n_words, 1) AS symbol_rate, 1000 * n_dup_lines // greatest(n_lines, 1) AS line_rate,
  1000 * word_chars // greatest(n_words, 1) AS length_rate FROM b),
k AS (SELECT lang, source, rate, bin, count(*) AS n FROM ({bins}) GROUP BY lang, source, rate, bin),
{level("own", ["lang", "source"])},{level("tongue", ["lang"])},{level("corpus", [])},
s AS (SELECT lang, source FROM k GROUP BY lang, source),
e AS (SELECT s.lang, s.source, {picked} FROM s
  LEFT JOIN own ON s.lang IS NOT DISTINCT FROM own.lang AND s.source IS NOT DISTINCT FROM own.source
  LEFT JOIN tongue ON s.lang IS NOT DISTINCT FROM tongue.lang LEFT JOIN corpus ON true),
f AS (SELECT c.*, e.* EXCLUDE (lang, source), n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM c LEFT JOIN e ON c.lang IS NOT DISTINCT FROM e.lang AND c.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(far)}) AS kept FROM f
"""
