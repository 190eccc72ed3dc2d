"""Latest row per key.

``row_number() OVER (PARTITION BY key ORDER BY ...) = 1``: Spark plans it with
a partial ``WindowGroupLimit`` before the shuffle, so each map task sends at
most one row per key and a key holding a third of all rows costs no more
than any other. The order is made total by appending every remaining column,
so ties (equal dates, duplicated rows from the joins) always resolve the same
way (D14).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys, order: list[Column]) -> list[Column]:
    """``order`` followed by every other column ascending, nulls first."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    return list(order) + rest


def latest(df: DataFrame, keys, order: list[Column], drop_null_keys: bool = True) -> DataFrame:
    """Keep the first row of each key under ``order`` (then all columns).

    Null keys never match a later join; ``drop_null_keys`` removes them before
    the shuffle instead of ranking them in one oversized group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def newest_first(ts: str) -> Column:
    """Newest first, rows without a date last."""
    return F.col(ts).desc_nulls_last()


def union_sources(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (U1); missing columns become null with ``allow_missing``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
