"""Joins whose keys may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join by ``keys`` that both sides have, once in the result; null meets null."""
    names = {k: f"_right_{k}" for k in keys}
    on = F.lit(True)
    for k, r in names.items():
        on = on & F.col(k).eqNullSafe(F.col(r))
    out = left.join(right.withColumnsRenamed(names), on, how)
    if how in ("full", "right"):
        out = out.withColumns({k: F.coalesce(k, r) for k, r in names.items()})
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())
