"""Column statistics by day that merge without a new scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.measures import count_where, rows
from ..sources.catalog import LAYOUTS, PROCESSED_DB
from ..sources.sinks import overwrite_path

SKETCH_BITS = 12
#: Three standard errors of a sketch of 2^12 slots.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)
_FIGURES = ("row_count", "null_count", "min_number", "max_number", "min_text", "max_text", "sketch")


def daily_statistics(df: DataFrame, columns: Sequence[str], by: str = "dt") -> DataFrame:
    """One row per day and column: rows, NULLs, extremes (of numbers or texts) and a sketch of distinct values.

    One pass, whatever the number of columns. Sketches hash numbers as texts, so any type fits.
    """
    figures = []
    for i, c in enumerate(columns):
        number = isinstance(df.schema[c].dataType, T.NumericType)
        as_number = F.col(c).cast("double") if number else F.lit(None).cast("double")
        as_text = F.lit(None).cast("string") if number else F.col(c).cast("string")
        figures += [
            rows().alias(f"row_count_{i}"), count_where(F.col(c).isNull()).alias(f"null_count_{i}"),
            F.min(as_number).alias(f"min_number_{i}"), F.max(as_number).alias(f"max_number_{i}"),
            F.min(as_text).alias(f"min_text_{i}"), F.max(as_text).alias(f"max_text_{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(f"sketch_{i}"),
        ]
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}_{i}").alias(f) for f in _FIGURES]) for i, c in enumerate(columns)])
    return df.groupBy(by).agg(*figures).select(by, F.explode(each).alias("s")).select(by, "s.*")


def merged_statistics(daily: DataFrame) -> DataFrame:
    """One row per column over all days of ``daily_statistics``; exact but for ``approx_distinct``."""
    return daily.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        *[f(n).alias(n) for n, f in (("min_number", F.min), ("max_number", F.max), ("min_text", F.min), ("max_text", F.max))],
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


def refresh_statistics(
    spark: SparkSession, name: str, folder: str, days: Sequence[str] | None = None, database: str = PROCESSED_DB,
) -> None:
    """Write the daily statistics of a table below ``folder``; with ``days`` only theirs, from a scan of these days."""
    table = spark.table(f"{database}.{name}")
    scanned = table if days is None else table.filter(F.col("dt").isin(list(days)))
    overwrite_path(daily_statistics(scanned, LAYOUTS[name].statistics), f"{folder}/{name}", ["dt"])


def stored_statistics(spark: SparkSession, name: str, folder: str) -> DataFrame:
    return merged_statistics(spark.read.orc(f"{folder}/{name}"))
