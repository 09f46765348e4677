"""Audits: row counts by stage, lost rows, broken domain rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline import fixed_values as fv
from shelfline.schema import CANONICAL

SKETCH_BITS = 14
# Three standard errors of a merged sketch of this size.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def audit(unified: DataFrame, deduplicated: DataFrame) -> DataFrame:
    """Rows before and after deduplication, products, first and last time, per platform."""
    before = unified.groupBy("platform").agg(F.count(F.lit(1)).alias("rows_in"))
    after = deduplicated.groupBy("platform").agg(
        F.count(F.lit(1)).alias("rows_out"), F.count_distinct("product_name").alias("products"),
        F.min("snapshot_time").alias("first_time"), F.max("snapshot_time").alias("last_time"),
        F.count_if(F.col("delivery_minutes").isNull()).alias("unparsed_minutes"))
    out = before.join(after, "platform", "left")
    # One row per platform is left here, so the window without a key sorts a handful.
    newest = F.max("last_time").over(Window.partitionBy())
    return out.withColumn("freshness_hours", F.timestamp_diff("HOUR", F.col("last_time"), newest))


def audit_states(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """What the overall audit needs of each group of rows, as states that can be merged: counts, extremes and a sketch of the
    product names (2^SKETCH_BITS bytes at most), in one pass and without a shuffle of names."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("snapshot_time").alias("first_time"), F.max("snapshot_time").alias("last_time"),
        F.count_if(F.col("delivery_minutes").isNull()).alias("unparsed_minutes"),
        F.hll_sketch_agg("product_name", F.lit(SKETCH_BITS)).alias("product_sketch"))


def audit_overall(states: DataFrame) -> DataFrame:
    """Per platform, and over all (``is_overall``, platform null): rows, first and last time, unparsed minutes, distinct products.

    ``states``: those of :func:`audit_states` by any keys with ``platform``.  ``products`` is an estimate that three times
    in a thousand is off by more than ``SKETCH_ERROR``; everything else is exact.  Null products are not counted."""
    overall = F.grouping("platform") == 1
    return states.rollup("platform").agg(
        overall.alias("is_overall"), F.when(overall, F.count_distinct("platform")).otherwise(F.lit(1)).alias("platforms"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
        F.coalesce(F.sum("unparsed_minutes"), F.lit(0)).alias("unparsed_minutes"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("product_sketch")), F.lit(0)).alias("products"))


def observed(df: DataFrame, observation) -> DataFrame:
    """Counts taken while another job writes ``df``; no job of their own."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"),
                      F.min("snapshot_time").alias("first_time"), F.max("snapshot_time").alias("last_time"),
                      F.count_if(F.col("snapshot_time").isNull()).alias("unparsed_times"))


def lossless_check(raw_ids: DataFrame, unified: DataFrame) -> DataFrame:
    """Per platform: ids in the raw feeds, in the unified table, and missing from either.  Both
    sides are tagged and grouped together: one shuffle instead of two anti-joins."""
    tagged = (raw_ids.select("platform", "record_id", F.lit(1).alias("raw"), F.lit(0).alias("uni"))
              .unionByName(unified.select("platform", "record_id", F.lit(0).alias("raw"), F.lit(1).alias("uni"))))
    ids = tagged.groupBy("platform", "record_id").agg(
        F.max("raw").alias("raw"), F.max("uni").alias("uni"), F.sum("raw").alias("raw_rows"), F.sum("uni").alias("uni_rows"))
    return ids.groupBy("platform").agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("raw").cast("bigint").alias("raw_ids"),
        F.sum("uni_rows").alias("unified_rows"),
        F.count_if((F.col("raw") == 1) & (F.col("uni") == 0)).alias("lost"),
        F.count_if((F.col("raw") == 0) & (F.col("uni") == 1)).alias("invented"))


def conforms(df: DataFrame) -> bool:
    """Whether the schema is the canonical one: names, order and types."""
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in CANONICAL.fields]


def domain_rules(location: str) -> dict[str, Column]:
    """Rule -> condition that holds for a good row."""
    return {
        "rating_range": F.col("rating").between(*fv.RATING_RANGE),
        "delivery_range": F.col("delivery_minutes").between(*fv.DELIVERY_RANGE),
        "discount_step": F.col("discount_pct").isin(*[float(d) for d in fv.DISCOUNT_STEPS]),
        "price_positive": F.col("effective_price") > 0,
        "location": F.col("location") == F.lit(location),
    }


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per platform and rule, nulls not counted, from one aggregate over the rows."""
    one = df.groupBy("platform").agg(*[F.count_if(~c).alias(name) for name, c in rules.items()],
                                     F.count(F.lit(1)).alias("checked"))
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]))
    return one.select("platform", "checked", rows.alias("r")).select("platform", "r.rule", "checked", "r.violations")
