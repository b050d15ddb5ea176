"""Exact distinct counts that add up from fine grains to coarse ones.

Each distinct value gets a number; a group's values are bitmaps over these numbers, 32,768 to a bitmap. The
bitmaps of an hour merge by OR into those of a day and of everything, so one pass over the facts serves all
grains, where a distinct count per grain would shuffle every fact once for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """value and id of each distinct value that is not NULL.

    Checkpointed, so an id stays what it is when a task runs again. Ids are dense within a partition.
    """
    values = df.select(F.col(column).alias("value")).filter("value is not null").distinct()
    return checkpointed(values.withColumn("id", F.monotonically_increasing_id()))


def bitmaps(df: DataFrame, column: str, ids: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, bucket and bits: which ids of a bucket a group holds; NULLs are an empty bitmap without bucket."""
    rows = df.select(*by, F.col(column).alias("value"))
    nulls = rows.filter("value is null").withColumn("id", F.lit(None).cast("bigint"))
    held = rows.join(ids, "value").unionByName(nulls)
    return held.groupBy(*by, F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def distinct_by_grain(bits: DataFrame, by: Sequence[str], grains: Sequence[Sequence[str]], name: str) -> DataFrame:
    """The distinct values of each group of each grain; columns a grain leaves out are NULL, ``grain`` tells which."""
    sets = [[*grain, "bucket"] for grain in grains]
    merged = bits.groupingSets(sets, *by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.grouping_id().alias("grain"))
    return merged.groupBy(*by, "grain").agg(F.sum(F.bitmap_count("bits")).alias(name))
