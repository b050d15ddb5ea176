"""Roll-ups of the daily sensor summary over several grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.labels import rolled_up
from ..functions.measures import half_up, mean, percent
from ..tables import Tables

GRAINS = [["dt", "device_id", "zone"], ["dt", "zone"], ["dt"], []]
KEYS = ("dt", "device_id", "zone")


def _temperatures() -> list[Column]:
    """The mean is the plain mean of the daily means."""
    return [
        half_up(mean("avg_temp"), 2).alias("avg_temperature"),
        half_up(F.min("min_temp"), 2).alias("min_temperature"),
        half_up(F.max("max_temp"), 2).alias("max_temperature"),
    ]


def _labels(device_label: str) -> list[Column]:
    return [
        rolled_up("dt", V.ALL_DATES).alias("date_key"),
        rolled_up("device_id", device_label).alias("device_key"),
        rolled_up("zone", V.ALL_ZONES).alias("zone_key"),
    ]


def grouping_sets(t: Tables) -> DataFrame:
    """Four grains in one pass: day and device and zone, day and zone, day, all."""
    anomalies, readings = F.sum("anomaly_count"), F.sum("total_readings")
    return (
        t.sensor_daily_summary.groupingSets(GRAINS, *KEYS)
        .agg(
            *_labels(V.ALL_DEVICES), *_temperatures(),
            half_up(mean("avg_humidity"), 2).alias("avg_humidity"),
            readings.alias("total_readings"),
            anomalies.alias("total_anomalies"),
            half_up(percent(anomalies, readings), 3).alias("anomaly_rate_pct"),
        )
        .drop(*KEYS)
        .orderBy("date_key", "zone_key", "device_key")
    )


def grouping_sets_report(t: Tables) -> DataFrame:
    """CSV report over the same grains, with its own labels and columns."""
    return (
        t.sensor_daily_summary.groupingSets(GRAINS, *KEYS)
        .agg(
            *_labels(V.ALL_DEVICES_SHORT), *_temperatures(),
            F.sum("total_readings").alias("total_readings"),
            F.sum("anomaly_count").alias("anomaly_sum"),
            half_up(mean("avg_humidity"), 2).alias("avg_humidity"),
        )
        .drop(*KEYS)
        .withColumnRenamed("anomaly_sum", "anomaly_count")
        .orderBy("date_key", "zone_key", "device_key")
    )


def _totals() -> list[Column]:
    return [
        F.sum("total_readings").alias("readings"),
        half_up(mean("avg_temp"), 2).alias("mean_temp"),
        F.sum("anomaly_count").alias("anomalies"),
    ]


def _with_totals(grouped) -> DataFrame:
    return (
        grouped.agg(
            rolled_up("dt", V.GRAND_TOTAL).alias("date_key"),
            rolled_up("zone", V.ZONE_TOTAL).alias("zone_key"),
            rolled_up("device_id", V.DEVICE_TOTAL).alias("device_key"),
            *_totals(),
        )
        .drop(*KEYS)
        .withColumnRenamed("mean_temp", "avg_temp")
    )


def _sorted(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(k) for k in ("date_key", "zone_key", "device_key")])


def rollup(t: Tables) -> DataFrame:
    """Day, zone, device from the finest grain up to the grand total."""
    return _sorted(_with_totals(t.sensor_daily_summary.rollup("dt", "zone", "device_id")))


def cube(t: Tables) -> DataFrame:
    """All combinations of day, zone and device."""
    return _sorted(_with_totals(t.sensor_daily_summary.cube("dt", "zone", "device_id")))


def weekly(t: Tables, with_year: bool = False) -> DataFrame:
    """Week and zone.

    Weeks carry no year, so the same week of two years is one group; the
    variant ``with_year`` tells them apart by the ISO year.
    """
    date = F.col("dt").try_cast("date")
    keys = ["week_number", "zone"]
    weeks = t.sensor_daily_summary.withColumn("week_number", F.weekofyear(date))
    if with_year:
        weeks = weeks.withColumn("iso_year", F.extract(F.lit("YEAROFWEEK"), date))
        keys = ["iso_year", *keys]
    anomalies, readings = F.sum("anomaly_count"), F.sum("total_readings")
    figures = weeks.groupBy(*keys).agg(
        F.min(date).cast("string").alias("week_start_date"),
        F.max(date).cast("string").alias("week_end_date"),
        readings.alias("weekly_readings"),
        half_up(mean("avg_temp"), 2).alias("weekly_avg_temp"),
        half_up(F.min("min_temp"), 2).alias("weekly_min_temp"),
        half_up(F.max("max_temp"), 2).alias("weekly_max_temp"),
        anomalies.alias("weekly_anomalies"),
        half_up(percent(anomalies, readings), 3).alias("weekly_anomaly_rate_pct"),
    )
    return figures.select(
        *keys[:-1], "week_start_date", "week_end_date", "zone", "weekly_readings", "weekly_avg_temp",
        "weekly_min_temp", "weekly_max_temp", "weekly_anomalies", "weekly_anomaly_rate_pct",
    ).orderBy(*keys)
