"""Joining and grouping on keys that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SPREAD = 1024


def salt(spread: Sequence[str], parts: int | Column) -> Column:
    """A part number taken from the row itself, so a repeated task deals the same way."""
    parts = F.lit(parts) if isinstance(parts, int) else parts
    return F.pmod(F.xxhash64(*spread), parts).cast("int")


def two_pass_groupby(
    df: DataFrame, keys: Sequence[str], partial: Sequence[Column], final: Sequence[Column],
    spread: Sequence[str], salts: int = 64,
) -> DataFrame:
    """Two-pass grouping: by key and salt, then by key.

    Sums, counts and distinct counts need no such help: Spark combines them
    before the shuffle, distinct ones in two exchanges. It serves results that
    do not shrink before the shuffle, such as the n-th value in an order: a
    salt's rows meet, and only its few candidates go on.
    """
    return (
        df.withColumn("_salt", salt(spread, salts))
        .groupBy(*keys, "_salt").agg(*partial)
        .groupBy(*keys).agg(*final)
    )


def skew_join(fact: DataFrame, dim: DataFrame, key: str, spread: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a fact to a dimension of any size in one scan of the fact.

    Spark broadcasts a dimension below its size limit and else splits the large
    parts of the shuffled fact (``forceOptimizeSkewedJoin`` keeps that on where
    a grouping by the key follows). It cannot split what matches nothing: in a
    ``left`` join facts without a key are spread over ``SPREAD`` keys of their
    own. ``how`` is ``inner`` or ``left`` (keep facts without a match).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if how == "inner":
        return fact.join(dim, key)
    absent = F.when(F.col(key).isNull(), salt(spread, SPREAD))
    keyed = fact.withColumn("_absent", absent)
    there = dim.withColumn("_absent", F.lit(None).cast("int")).withColumnRenamed(key, "_key")
    same = (F.col(key) == F.col("_key")) & F.coalesce(keyed["_absent"], F.lit(-1)).eqNullSafe(F.coalesce(there["_absent"], F.lit(-1)))
    return keyed.join(there, same, "left").drop("_absent", "_key")
