"""Aggregate building blocks shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half up, as DOUBLE, on the decimal reading of ``value``.

    A mean of doubles carries noise in its last bits that depends on the order
    of the partial sums. Reading it as a DECIMAL with six spare digits drops
    the noise, so the same data gives the same figure under any partitioning,
    and is far too fine to lift a value over a half.
    The cast runs once per group, the summing stays on doubles. Values no
    decimal can hold (NaN, infinite, huge) round as doubles.
    """
    exact = F.round(value.try_cast(f"decimal(38,{digits + 6})"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def mean(value: str | Column) -> Column:
    """Average of the non-NULL values as DOUBLE; NULL for none."""
    return F.try_divide(F.sum(value), F.count(value)).cast("double")


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0 for none. NULL does not hold."""
    return F.coalesce(F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, reading an empty whole as one row."""
    return part.cast("double") * F.lit(100.0) / F.greatest(whole.cast("double"), F.lit(1.0))


def rows() -> Column:
    return F.count(F.lit(1))
