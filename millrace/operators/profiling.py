"""Column statistics in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import count_where, half_up, mean


def _unpivot(one_row: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row of figures to one row per column."""
    items = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}_{i}").alias(n) for n in names])
             for i, c in enumerate(columns)]
    return one_row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value as text, NULL count and mean text length per column."""
    figures = []
    for i, c in enumerate(columns):
        figures += [
            F.min(c).cast("string").alias(f"min_value_{i}"),
            F.max(c).cast("string").alias(f"max_value_{i}"),
            count_where(F.col(c).isNull()).alias(f"null_count_{i}"),
            half_up(mean(F.length(F.col(c).cast("string"))), 4).alias(f"avg_length_{i}"),
        ]
    return _unpivot(df.agg(*figures), columns, ["min_value", "max_value", "null_count", "avg_length"])


def column_cardinality(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """Estimated number of distinct values per column."""
    figures = [F.approx_count_distinct(c, rsd).alias(f"approx_distinct_{i}") for i, c in enumerate(columns)]
    return _unpivot(df.agg(*figures), columns, ["approx_distinct"])


def checked_cardinality(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """Exact distinct values per column, and whether the estimate lies within three of its standard errors."""
    exact = df.agg(*[F.countDistinct(c).alias(f"distinct_values_{i}") for i, c in enumerate(columns)])
    both = _unpivot(exact, columns, ["distinct_values"]).join(column_cardinality(df, columns, rsd), "column_name")
    near = F.abs(F.col("approx_distinct") - F.col("distinct_values")) <= F.greatest(F.col("distinct_values") * (3 * rsd), F.lit(1.0))
    return both.select("column_name", "distinct_values", near.alias("estimate_is_near"))
