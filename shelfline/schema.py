"""Canonical listing table and the raw layouts it is made from."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import types as T

from shelfline import fixed_values as fv

CANONICAL = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("snapshot_time", T.TimestampType()),
    T.StructField("location", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("pack_size", T.IntegerType()),
    T.StructField("pack_unit", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("mrp", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("effective_price", T.DoubleType()),
    T.StructField("price_per_unit", T.DoubleType()),
    T.StructField("in_stock", T.BooleanType()),
    T.StructField("stock_remaining", T.IntegerType()),
    T.StructField("units_ordered", T.IntegerType()),
    T.StructField("revenue_inr", T.DoubleType()),
    T.StructField("delivery_minutes", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_peak_hour", T.BooleanType()),
    T.StructField("weather", T.StringType()),
    T.StructField("is_raining", T.BooleanType()),
    T.StructField("seasonal_factor", T.DoubleType()),
    T.StructField("bulk_discount_pct", T.DoubleType()),
    T.StructField("festival_demand_mult", T.DoubleType()),
    T.StructField("month", T.IntegerType()),
])

DEDUP_KEY = ("record_id", "platform", "snapshot_time")
PACK_KEY = ("product_name", "pack_size", "pack_unit")


@dataclass(frozen=True)
class Feed:
    """Layout of one vendor's raw files.

    ``columns`` maps raw to canonical names.  ``stock_word`` is the word for "in stock"
    (None: the feed has a boolean).  ``minutes_text``: delivery time is text such as
    "15 mins".  ``int_flags``: these canonical flags arrive as 0/1.
    """

    columns: Mapping[str, str]
    dropped: tuple[str, ...] = ()
    stock_word: str | None = None
    minutes_text: bool = False
    int_flags: tuple[str, ...] = ()

    def raw_schema(self) -> T.StructType:
        """Types as the vendors' Parquet files have them: int64, float64, bool, string."""
        fields = []
        for raw, name in self.columns.items():
            kind = CANONICAL[name].dataType
            if name == "snapshot_time" or (name == "in_stock" and self.stock_word):
                kind = T.StringType()
            elif name == "delivery_minutes" and self.minutes_text:
                kind = T.StringType()
            elif name == "discount_pct" or name in self.int_flags or isinstance(kind, T.IntegerType):
                kind = T.LongType()
            fields.append(T.StructField(raw, kind))
        return T.StructType(fields + [T.StructField(c, T.StringType()) for c in self.dropped])


FEED_A = Feed(fv.FEED_A_COLUMNS, fv.FEED_A_DROPPED, stock_word=fv.FEED_A_STOCK_WORD)
FEED_B = Feed(fv.FEED_B_COLUMNS, fv.FEED_B_DROPPED, stock_word=fv.FEED_B_STOCK_WORD,
              int_flags=("is_weekend", "is_peak_hour"))
FEED_C = Feed(fv.FEED_C_COLUMNS, fv.FEED_C_DROPPED, minutes_text=True)
