"""One query per operator of this subpackage, over the whole tables, and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.llm import (chat, exact_dedup, hard_negatives, packing, periodic_runs, pii, quality_classifier, quality_rules,
                           shingle_join, simhash_trie, toxicity, warc, word_bpe)
from shelfline.llm.common import table


def op1_chat_format(spark, sf):
    said = "</s>[INST] ok [/INST]"
    known = "SELECT conv_id, turn, role, text FROM {rows} UNION ALL SELECT * FROM VALUES " \
            "(-1L, 0L, 'user', {said}), (-1L, 1L, 'assistant', {said})"
    rows = spark.sql(known, rows=table(spark, sf, "conversations"), said=said)
    return chat.chat_digests(chat.formatted_conversations(rows))


def op2_warc(spark, sf):
    return warc.archived(table(spark, sf, "pages")).drop("payload", "url")


def op3_pii(spark, sf):
    return pii.spans_report(table(spark, sf, "documents"))


def op4_quality_rules(spark, sf):
    return quality_rules.judged(table(spark, sf, "documents"))


def op5_quality_classifier(spark, sf):
    return quality_classifier.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_word_bpe(spark, sf):
    return word_bpe.token_digests(word_bpe.encode_and_decode(table(spark, sf, "documents")))


def op7_shingle_join(spark, sf):
    return shingle_join.similar_components(table(spark, sf, "documents"))


def op8_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


def op9_mixture_packing(spark, sf):
    return packing.piece_digests(packing.pack(table(spark, sf, "documents")))


def op10_toxicity(spark, sf):
    return toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_simhash(spark, sf):
    return simhash_trie.near_duplicates(table(spark, sf, "documents"))


def op12_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    return hard_negatives.hard_negatives(rows.select("vec_id", hard_negatives.relabelled(F.col("label"), F.col("vec_id")).alias("label"), "embedding"))


def op13_periodic_runs(spark, sf):
    return periodic_runs.periodic_runs(table(spark, sf, "documents"), digests_only=True, plant=True)


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_warc, op3_pii, op4_quality_rules, op5_quality_classifier, op6_word_bpe, op7_shingle_join, op8_exact_dedup,
    op9_mixture_packing, op10_toxicity, op11_simhash, op12_hard_negatives, op13_periodic_runs)}
ORACLES: dict[str, str] = {"op1_chat_format": chat.oracle(), "op4_quality_rules": quality_rules.oracle(), "op8_exact_dedup": exact_dedup.ORACLE,
                           "op12_hard_negatives": hard_negatives.oracle()}
