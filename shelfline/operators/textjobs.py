"""Labelling of shopper questions as a batch job over a text table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fv
from shelfline.functions.numbers import col

# Unicode digits and spaces, and only \n ends a line for ".".
_FLAGS = "(?dU)"
PIECE = 64  # positions of a text that one row of the name search covers
TABLE_BITS = 20  # the table that positions are tried against has 2^20 bits, 128 kB


def intent_expressions(platforms) -> dict[str, str]:
    """One expression per intent, in the order in which they are tried."""
    names = "|".join(re.escape(p) for p in platforms)
    return {intent: "|".join(p.replace("{platforms}", names) for p in patterns)
            for intent, patterns in fv.INTENT_PATTERNS.items()}


def _first_only(pattern: str) -> str:
    """The same matches in linear time: after a platform name only the first joining word is tried.
    If no platform follows that one on the line, none follows a later one."""
    return pattern.replace(".*(?:vs|versus|and|or)", "(?>.*?(?:vs|versus|and|or))")


def intent_label(text: Column | str, platforms) -> Column:
    lowered = F.lower(col(text))
    expr = F
    for intent, pattern in intent_expressions(platforms).items():
        expr = expr.when(lowered.rlike(_FLAGS + _first_only(pattern)), F.lit(intent))
    return expr.otherwise(F.lit(fv.DEFAULT_INTENT))


def pack_mention(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(F.lower(col(text)), _FLAGS + fv.PACK_PATTERN, 0), F.lit(""))


def platform_mention(text: Column | str, aliases: dict[str, tuple[str, ...]]) -> Column:
    """Platforms whose name or alias occurs, as an array; null if none does."""
    lowered = F.lower(col(text))
    hits = []
    for platform, words in aliases.items():
        found = F.lit(False)
        for word in words:
            found = found | F.contains(lowered, F.lit(word))
        hits.append(F.when(found, F.lit(platform)))
    array = F.array_compact(F.array(*hits))
    return F.when(F.size(array) > 0, array)


def product_mention(questions: DataFrame, catalogue: DataFrame, word_boundaries: bool = False,
                    table_bits: int = TABLE_BITS) -> DataFrame:
    """Adds ``product``: the longest catalogue name that occurs in the text, null if none does.

    Names of equal length are taken by ``position`` if the catalogue has it, then by name.  Null and
    empty names are never mentioned; a null text mentions nothing; repeated texts and ids are fine.

    A name is looked up by its seed, as many of its first letters as the largest power of two that
    it has, so that names of all lengths need few seed lengths and a short name does not weaken the
    seeds of the others.  Long texts are cut into pieces that overlap by the longest name, so the cost is linear in the text.
    Every distinct text tries its seeds at each position against a table of 2^``table_bits`` bits, which lets through the
    seeds of names and as large a share of the others as it has bits set (a tenth with 100,000 names); only these reach a join.  There
    seeds meet names by equality, and what follows the position decides.  With more names than bits the table
    sorts out less, and the result is the same.
    """
    order = ["position", "product_name"] if "position" in catalogue.columns else ["product_name"]
    key = F.lower("product_name")
    key = F.concat(F.lit(" "), key, F.lit(" ")) if word_boundaries else key
    names = catalogue.select(*order).filter("length(product_name) > 0").distinct().withColumn("key", key)
    letters = F.pow(F.lit(2), F.floor(F.log2(F.length("key")))).cast("int")
    names = names.withColumn("seed", F.substring("key", F.lit(1), letters))
    # At most one seed length per power of two.
    sizes = names.agg(F.struct(F.collect_set(F.length("seed")).alias("seeds"),
                               F.max(F.length("key")).alias("longest")).alias("z")).select("z").scalar()
    text = _padded(F.lower("text")) if word_boundaries else F.lower("text")
    texts = questions.select("text").filter("text is not null").distinct().select(
        F.sha2("text", 256).alias("_text"), text.alias("t"))
    # The work per byte that follows is large; with a given number of partitions it is not merged into few tasks.
    parts = int(questions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.repartition(parts, "_text").select("_text", "t", sizes.alias("z")).filter(F.size("z.seeds") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.length("t"), F.lit(PIECE)))
    pieces = texts.select("_text", "t", "z", starts.alias("from")).select(
        "_text", "z.seeds", "z.longest", F.substring("t", F.col("from") + 1, F.lit(PIECE - 1) + F.col("z.longest")).alias("piece"))
    spots = pieces.filter("piece <> ''").select("*", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(PIECE), F.length("piece")))).alias("at"))
    ahead = spots.select("_text", "seeds", F.substring("piece", F.col("at"), F.col("longest")).alias("ahead"))
    offered = ahead.select("_text", "ahead", F.explode("seeds").alias("n")).filter(F.length("ahead") >= F.col("n"))
    offered = offered.withColumn("seed", F.substring("ahead", F.lit(1), F.col("n"))).filter(
        _in_table("seed", _bit_table(names, table_bits), table_bits))
    hits = offered.join(names, "seed").filter(F.startswith("ahead", "key"))
    best = hits.groupBy("_text").agg(
        F.min(F.struct((-F.length("product_name")).alias("shorter"), *[F.col(c) for c in order])).alias("b"))
    best = best.select("_text", F.col("b.product_name").alias("product"))
    return questions.withColumn("_text", F.sha2("text", 256)).join(best, "_text", "left").drop("_text")


def _slot(seed: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(seed), F.lit(1 << bits).cast("bigint"))


def _bit_table(names: DataFrame, bits: int) -> Column:
    """Bits of the hashes of all seeds, as one array of 2^(bits - 6) longs."""
    one = F.lit(1).cast("bigint")
    some = names.select(F.shiftright(_slot("seed", bits), 6).alias("word"),
                        F.call_function("shiftleft", one, (_slot("seed", bits) % 64).cast("int")).alias("bit"))
    none = names.sparkSession.range(1 << bits - 6).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bit"))
    table = none.unionByName(some).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    rows = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return table.agg(F.transform(rows, lambda w: w["bits"])).scalar()


def _in_table(seed: str, table: Column, bits: int) -> Column:
    return F.getbit(F.get(table, F.shiftright(_slot(seed, bits), 6).cast("int")), (_slot(seed, bits) % 64).cast("int")) == 1


def _padded(text: Column) -> Column:
    """Words separated and surrounded by single spaces."""
    return F.concat(F.lit(" "), F.regexp_replace(text, r"(?U)[^\w-]+", " "), F.lit(" "))


def normal_pack(size: Column, unit: Column) -> tuple[Column, Column]:
    """Size and unit with kilograms as grams, litres as millilitres, and one spelling per unit."""
    unit = F.lower(unit)
    factor, name = F, F
    for spelled, (plain, times) in fv.PACK_UNITS.items():
        factor, name = factor.when(unit == spelled, F.lit(times)), name.when(unit == spelled, F.lit(plain))
    return size.cast("bigint") * factor.otherwise(F.lit(1)), name.otherwise(unit)


def asked_pack(pack: Column | str) -> tuple[Column, Column]:
    """Normal size and unit of a mentioned pack; null where none is, or the number is too large."""
    number = F.regexp_extract(col(pack), _FLAGS + r"^(\d+)", 1).try_cast("int")
    unit = F.nullif(F.regexp_extract(col(pack), _FLAGS + r"^\d+\s*(\D+)$", 1), F.lit(""))
    return normal_pack(number, F.when(number.isNotNull(), unit))


def parse_questions(questions: DataFrame, catalogue: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Intent, product, pack and platforms of every question."""
    return product_mention(questions, catalogue).withColumns({
        "intent": intent_label("text", aliases),
        "pack": pack_mention("text"),
        "platforms_named": platform_mention("text", aliases),
    })


def intent_counts(parsed: DataFrame, *by: str) -> DataFrame:
    return parsed.groupBy(*by, "intent").agg(F.count(F.lit(1)).alias("questions"))


def answer_questions(parsed: DataFrame, records: DataFrame, latest: DataFrame, trending: DataFrame) -> DataFrame:
    """Joins every parsed question to the recommendation records, by product, size and unit.

    Sizes are compared in grams and millilitres, so 1 kg is the pack of 1000 g and 500 g is not that of
    500 ml.  Without a mentioned pack it is the product's smallest number, then the first unit by name.
    Of records that are the same pack in two spellings, the one with the smaller number answers.
    ``pack_size`` and ``pack_unit`` of the result are the normal ones.  Questions on
    delivery and on trends have the same answer for all, read as scalars.
    """
    columns = ("platforms", "recommended_platform", "best_price_platform")
    size, unit = normal_pack(F.col("pack_size"), F.col("pack_unit"))
    first = F.min(F.struct("pack_size", "pack_unit", *columns)).alias("r")
    per_pack = records.groupBy("product_name", size.alias("_size"), unit.alias("_unit")).agg(first)
    smallest = records.groupBy("product_name").agg(F.min(F.struct(size.alias("size"), unit.alias("unit"))).alias("s"))
    fastest = latest.agg(F.min(F.struct("delivery_minutes", "platform")).alias("f")).select("f.platform").scalar()
    # At most as many rows as the trending report has.
    top = trending.agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct((-F.col("growth")).alias("g"), "product_name", "platform"))), lambda s: s["product_name"]), ", ")
    ).scalar()

    # Most texts name no product.  Their join key is made from the id, so they match nothing and
    # spread over all partitions instead of meeting in the one of the null key.
    key = F.coalesce("product", F.concat(F.lit("\u0000"), "question_id"))
    size, unit = asked_pack("pack")
    asked = parsed.withColumn("product_name", key).join(smallest, "product_name", "left")
    asked = asked.withColumns({"pack_size": F.when(unit.isNull(), F.col("s.size")).otherwise(size),
                               "pack_unit": F.coalesce(unit, "s.unit")})
    asked = asked.withColumns({"_size": F.coalesce("pack_size", F.lit(-1)), "_unit": F.coalesce("pack_unit", F.lit(""))})
    joined = asked.join(per_pack, ["product_name", "_size", "_unit"], "left")
    compared = F.filter("r.platforms", lambda p: F.coalesce(
        F.array_contains(F.col("platforms_named"), p["platform"]), F.lit(True)))
    answer = (F.when(F.col("intent") == "check_delivery", fastest)
              .when(F.col("intent") == "trending", top)
              .when(F.col("intent") == "find_cheapest", F.col("r.best_price_platform"))
              .when(F.col("intent") == "compare", F.nullif(
                  F.array_join(F.transform(compared, lambda p: p["platform"]), " > "), F.lit("")))
              .otherwise(F.col("r.recommended_platform")))
    return joined.select("question_id", "intent", "product", "pack_size", "pack_unit", "platforms_named",
                         answer.alias("answer"))
