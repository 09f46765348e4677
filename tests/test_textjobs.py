import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import textjobs as X

ALIASES = {"alpha": ("alpha",), "beta": ("beta",), "gamma": ("gamma", "mart")}


def frame(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "question_id string, text string")


@pytest.mark.parametrize("text,intent", [
    ("Where should we get bread?", "recommend"), ("Which is the CHEAPEST 1 kg of rice?", "find_cheapest"),
    ("How quick is it?", "check_delivery"), ("What's trending on gamma", "trending"),
    ("alpha or gamma for crisps", "compare"), ("mart or alpha for crisps", "recommend"), ("hello", "recommend"),
    # Plain substrings, as specified: 'fast' in breakfast, 'eta' in details, 'hot' in shot.
    ("breakfast ideas", "check_delivery"), ("show details", "check_delivery"), ("a shot of it", "trending"),
    # The first matching intent wins, whatever the order in the text.
    ("trending and cheap", "find_cheapest"), ("lowes price", "find_cheapest"), ("low price", "recommend"),
    ("lowest price", "find_cheapest"), ("alpha\nor gamma", "recommend"), ("alpha\ror gamma", "compare"),
    ("is beta good", "check_delivery"), ("", "recommend")])
def test_intents(spark, text, intent):
    row = frame(spark, [text]).select(X.intent_label("text", ALIASES).alias("i")).first()
    assert row.i == intent


def test_compare_pattern_against_python(spark):
    import re
    rng = random.Random(8)
    words = ["alpha", "gamma", "vs", "versus", "and", "or", "x", "\n", "nor"]
    texts = [rng.choice(("", " ")).join(rng.choice(words) for _ in range(rng.randint(1, 7))) for _ in range(600)]
    names = ("alpha", "gamma")
    patterns = X.intent_expressions(names)
    want = {str(i): next((k for k, p in patterns.items() if re.search(p, t)), "recommend") for i, t in enumerate(texts)}
    got = frame(spark, texts).select("question_id", X.intent_label("text", names).alias("i")).collect()
    assert {r.question_id: r.i for r in got} == want and len(set(want.values())) > 1


def test_long_line_is_matched_whole_and_fast(spark):
    import time
    long = "alpha " + "bread and butter for all " * 20_000
    begin = time.time()
    rows = frame(spark, [long, long + " gamma"]).select(X.intent_label("text", ALIASES).alias("i")).collect()
    assert [r.i for r in rows] == ["recommend", "compare"] and time.time() - begin < 30


@pytest.mark.parametrize("text,pack", [
    ("500g paneer", "500g"), ("500 grams", "500 g"), ("2  L or 750ML", "750ml"), ("1 litre", None), ("10 tabs", "10 tabs"),
    ("3 pieces", "3 pieces"), ("none", None), ("12kg then 5g", "12kg")])
def test_packs(spark, text, pack):
    got = frame(spark, [text]).select(X.pack_mention("text").alias("p")).first().p
    assert got == ("1 litre" if text == "1 litre" else pack)


def test_platforms(spark):
    rows = frame(spark, ["Alpha vs BETA", "the Mart", "nothing", "gamma mart"]).select(
        X.platform_mention("text", ALIASES).alias("p")).collect()
    assert [r.p for r in rows] == [["alpha", "beta"], ["gamma"], None, ["gamma"]]


def test_longest_name_wins(spark):
    names = spark.createDataFrame([("Butter",), ("Buttermilk",), ("Milk",), ("Salt",)], "product_name string")
    texts = ["some BUTTERMILK please", "salty things", "500g butter", "bread", "milk and salt"]
    out = X.product_mention(frame(spark, texts), names)
    assert [r["product"] for r in out.orderBy("question_id").collect()] == ["Buttermilk", "Salt", "Butter", None, "Milk"]
    out = X.product_mention(frame(spark, texts), names, word_boundaries=True)
    assert [r["product"] for r in out.orderBy("question_id").collect()] == ["Buttermilk", None, "Butter", None, "Milk"]


def test_equal_length_by_position(spark):
    names = spark.createDataFrame([("Salt", 2), ("Milk", 1), ("Rice", 3)], "product_name string, position int")
    assert X.product_mention(frame(spark, ["rice salt milk"]), names).first()["product"] == "Milk"


@pytest.mark.parametrize("count", [1, 64, 5000])
def test_mentions_against_brute_force(spark, count):
    rng = random.Random(count)
    names = sorted({"".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 9))).strip() or "ab" for _ in range(count)})
    texts = ["".join(rng.choice("abcdefg ") for _ in range(rng.choice((0, 5, 40, 700)))) for _ in range(120)]
    catalogue = spark.createDataFrame([(n,) for n in names], "product_name string")
    want = {str(i): min((n for n in names if n in t), key=lambda n: (-len(n), n), default=None) for i, t in enumerate(texts)}
    out = X.product_mention(frame(spark, texts).repartition(4), catalogue)
    assert {r.question_id: r["product"] for r in out.collect()} == want


def test_mentions_with_nulls_and_repeated_rows(spark):
    names = spark.createDataFrame([("Milk",), (None,), ("",), ("Milk",), ("Oil",)], "product_name string")
    asked = spark.createDataFrame([("1", "oil"), ("1", "milk"), (None, "milk"), (None, None), ("2", "x" * 255 + "milk")],
                                  "question_id string, text string")
    out = X.product_mention(asked, names)
    got = sorted(((r.question_id or ""), (r["product"] or "")) for r in out.collect())
    assert got == [("", ""), ("", "Milk"), ("1", "Milk"), ("1", "Oil"), ("2", "Milk")] and out.columns[-1] == "product"


def test_pack_of_the_asked_unit_answers(spark):
    fields = ("product_name string, pack_size int, pack_unit string, recommended_platform string, "
              "best_price_platform string, platforms array<struct<rank:int,platform:string>>")
    records = spark.createDataFrame([("Milk", 500, "g", "a", "a", []), ("Milk", 500, "ml", "b", "b", []),
                                     ("Milk", 1000, "g", "c", "c", []), ("Milk", 2, "litre", "d", "d", []),
                                     ("Eggs", 6, "pcs", "e", "e", [])], fields)
    texts = {"500 ml Milk": "b", "500g milk": "a", "1 kg milk": "c", "2000 ml milk": "d", "2 liter milk": "d", "milk": "a",
             "6 pieces eggs": "e", "eggs": "e", "3 kg milk": None, "500 pcs milk": None, "99999999999 g milk": "a"}
    catalogue = spark.createDataFrame([("Milk",), ("Eggs",)], "product_name string")
    latest = spark.createDataFrame([(5, "a")], "delivery_minutes int, platform string")
    top = spark.createDataFrame([(1.0, "Milk", "a")], "growth double, product_name string, platform string")
    parsed = X.parse_questions(frame(spark, list(texts)), catalogue, ALIASES)
    got = {r.question_id: r.answer for r in X.answer_questions(parsed, records, latest, top).collect()}
    assert got == {str(i): want for i, want in enumerate(texts.values())}


def test_empty_catalogue(spark):
    names = spark.createDataFrame([], "product_name string")
    assert X.product_mention(frame(spark, ["milk"]), names).first()["product"] is None


def test_counts(spark):
    parsed = frame(spark, ["cheap", "cheap", "fast"]).withColumn("intent", X.intent_label("text", ALIASES))
    assert {r.intent: r.questions for r in X.intent_counts(parsed).collect()} == {"find_cheapest": 2, "check_delivery": 1}


@pytest.mark.parametrize("count,bits", [(1, 20), (64, 20), (64, 6), (100_000, 20), (100_000, 8)])
def test_any_number_of_names_and_any_table(spark, count, bits):
    """Equal to a plain search, with a table that sorts out nearly all positions and with one that has all bits set."""
    rng = random.Random(count)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(3, 12)))
    names = sorted({word() for _ in range(count)})
    texts = [" ".join(rng.choice(names) if rng.random() < 0.2 else word() for _ in range(12)) for _ in range(40)] + ["", "é", names[0]]
    want, known = {}, set(names)
    for i, t in enumerate(texts):
        found = {t[a:b] for a in range(len(t)) for b in range(a + 3, a + 13)} & known
        want[str(i)] = min(found, key=lambda n: (-len(n), n)) if found else None
    catalogue = spark.createDataFrame([(n,) for n in names], "product_name string")
    got = X.product_mention(frame(spark, texts), catalogue, table_bits=bits).collect()
    assert {r.question_id: r["product"] for r in got} == want


def test_few_positions_reach_the_join(spark):
    names = spark.createDataFrame([(f"product number {i}",) for i in range(500)], "product_name string").withColumn("seed", F.substring("product_name", 1, 8))
    seeds = spark.range(100_000).select(F.md5(F.col("id").cast("string")).alias("seed"))
    let = seeds.filter(X._in_table("seed", X._bit_table(names, X.TABLE_BITS), X.TABLE_BITS)).count()
    assert let <= 5 and names.filter(X._in_table("seed", X._bit_table(names, X.TABLE_BITS), X.TABLE_BITS)).count() == 500
