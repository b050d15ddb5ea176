"""Labels and reason codes, first match wins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from . import fixed_values as V


def first_match(pairs: list[tuple[Column, Column | str]], otherwise: Column | str | None = None) -> Column:
    """The value of the first condition that holds."""
    result = None
    for condition, value in pairs:
        value = F.lit(value) if isinstance(value, str) else value
        result = F.when(condition, value) if result is None else result.when(condition, value)
    if otherwise is None:
        return result
    return result.otherwise(F.lit(otherwise) if isinstance(otherwise, str) else otherwise)


def day_name(dow: Column) -> Column:
    return first_match([(dow == n, name) for n, name in V.DAY_NAMES.items()])


def status_class(status: Column, names: Mapping[int, str] = V.STATUS_CLASSES) -> Column:
    return first_match(
        [(status.between(d * 100, d * 100 + 99), name) for d, name in names.items()],
        V.STATUS_CLASS_OTHER,
    )


def out_of_range() -> Column:
    """Readings outside the physical bounds."""
    t, h = F.col("temperature"), F.col("humidity")
    return (t > V.TEMP_MAX) | (t < V.TEMP_MIN) | (h > V.HUMIDITY_MAX) | (h < V.HUMIDITY_MIN)


def range_reasons() -> list[tuple[Column, str]]:
    t, h = F.col("temperature"), F.col("humidity")
    return [
        (t > V.TEMP_MAX, V.EXTREME_HIGH_TEMP),
        (t < V.TEMP_MIN, V.EXTREME_LOW_TEMP),
        (h > V.HUMIDITY_MAX, V.INVALID_HUMIDITY_HIGH),
        (h < V.HUMIDITY_MIN, V.INVALID_HUMIDITY_LOW),
    ]


def no_reading() -> Column:
    return F.col("temperature").isNull() | F.col("humidity").isNull()


def anomaly_reason() -> Column:
    """Reason code of a reading. The warnings are never reached for readings
    already filtered to the physical bounds; they serve unfiltered input."""
    t = F.col("temperature")
    return first_match(
        [(no_reading(), V.MISSING_READING)]
        + range_reasons()
        + [(t > V.TEMP_WARN_HIGH, V.HIGH_TEMP_WARNING), (t < V.TEMP_WARN_LOW, V.LOW_TEMP_WARNING)],
        V.UNSPECIFIED_ANOMALY,
    )


def quality_score() -> Column:
    t, status = F.col("temperature"), F.col("status")
    return first_match(
        [
            (status.isin(V.STATUS_MISSING, V.STATUS_ANOMALY), F.lit(V.SCORE_INVALID)),
            (F.col("is_duplicate"), F.lit(V.SCORE_DUPLICATE)),
            (no_reading(), F.lit(V.SCORE_INVALID)),
            ((t > V.SCORE_TEMP_HIGH) | (t < V.SCORE_TEMP_LOW), F.lit(V.SCORE_EXTREME)),
        ],
        F.lit(V.SCORE_GOOD),
    )


def temp_breach() -> Column:
    t = F.col("temperature")
    return (t < F.col("alert_temp_min")) | (t > F.col("alert_temp_max"))


def humidity_breach() -> Column:
    h = F.col("humidity")
    return (h < F.col("alert_humidity_min")) | (h > F.col("alert_humidity_max"))


def threshold_alert() -> Column:
    """Which threshold of its own device a reading breaks, in words."""

    def broken(value: str, sign: str, limit: str, unit: str, code: str) -> tuple[Column, Column]:
        v, bound = F.col(value), F.col(limit)
        text = F.concat(
            F.lit(f"{code} ("), v.cast("string"), F.lit(f"{unit} {sign} "),
            bound.cast("string"), F.lit(f"{unit} threshold)"),
        )
        return (v < bound if sign == "<" else v > bound), text

    return first_match(
        [
            broken("temperature", "<", "alert_temp_min", "°C", V.TEMP_TOO_LOW),
            broken("temperature", ">", "alert_temp_max", "°C", V.TEMP_TOO_HIGH),
            broken("humidity", "<", "alert_humidity_min", "%", V.HUMIDITY_TOO_LOW),
            broken("humidity", ">", "alert_humidity_max", "%", V.HUMIDITY_TOO_HIGH),
        ],
        V.WITHIN_THRESHOLD,
    )


def rolled_up(key: str, label: str) -> Column:
    """The key, or the label where the grouping has rolled it up.

    ``grouping`` tells a rolled-up key from a key that is NULL in the data.
    """
    return F.when(F.grouping(key) == 1, F.lit(label)).otherwise(F.col(key))
