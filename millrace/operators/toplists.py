"""Top-k lists and restriction to their members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows in an order without ties; every task keeps k rows at most, so nothing is sorted in full."""
    return df.orderBy(*order).limit(k)


def top_wide(df: DataFrame, k: int, key: str, *order: Column | str) -> DataFrame:
    """The same for wide rows with a unique ``key``: only the order and the key are ranked, then k rows are fetched."""
    leaders = top(df, k, *order).select(F.col(key).alias("_leader"))
    # Broadcast: k keys.
    return df.join(F.broadcast(leaders), F.col(key) == F.col("_leader"), "left_semi").orderBy(*order)


def keep_top_keys(df: DataFrame, key: str, measure: str, k: int) -> DataFrame:
    """Rows whose key is among the k with the largest sum; equal sums go by key."""
    leaders = top(
        df.groupBy(key).agg(F.sum(measure).alias("_total")), k, F.desc("_total"), F.col(key)
    ).select(key)
    # Broadcast: k rows.
    return df.join(F.broadcast(leaders), key, "left_semi")
