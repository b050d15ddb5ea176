"""Sensor anomalies, alerts and device health."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.labels import (
    anomaly_reason, first_match, humidity_breach, no_reading, out_of_range, range_reasons,
    temp_breach, threshold_alert,
)
from ..functions.measures import count_where, half_up, mean, percent, rows
from ..operators.skew import skew_join
from ..operators.toplists import top_wide
from ..tables import Tables


def anomaly_types(t: Tables) -> DataFrame:
    """Out-of-range or missing readings by device, zone and reason."""
    return (
        t.sensor_readings.filter(no_reading() | out_of_range())
        .withColumn("anomaly_type", anomaly_reason())
        .groupBy("device_id", "zone", "anomaly_type")
        .agg(
            rows().alias("occurrence_count"),
            F.min("timestamp_ts").alias("first_occurrence"),
            F.max("timestamp_ts").alias("last_occurrence"),
            half_up(F.min("temperature"), 2).alias("min_temp_observed"),
            half_up(F.max("temperature"), 2).alias("max_temp_observed"),
        )
        .orderBy(F.desc("occurrence_count"), "device_id", "zone", "anomaly_type")
    )


def anomaly_rate(t: Tables) -> DataFrame:
    """Share of anomalous or missing readings per device."""
    bad = F.col("status").isin(V.STATUS_ANOMALY, V.STATUS_MISSING)
    return (
        t.sensor_readings.groupBy("device_id", "zone")
        .agg(
            rows().alias("total_readings"),
            count_where(bad).alias("anomaly_count"),
            half_up(percent(count_where(bad), rows()), 2).alias("anomaly_rate_pct"),
            half_up(mean("data_quality_score"), 3).alias("avg_quality_score"),
        )
        .orderBy(F.desc("anomaly_rate_pct"), "device_id", "zone")
    )


def threshold_alerts(
    t: Tables, first_day: str = "2024-01-15", last_day: str = "2024-01-20", k: int = 1000
) -> DataFrame:
    """Readings of a few days against the thresholds of their own device.

    The join carries no hint: Spark broadcasts the registry if it is small,
    and else splits hot devices, as no grouping follows.
    """
    readings = t.sensor_readings.filter(
        (F.col("status") != V.STATUS_MISSING) & F.col("dt").between(first_day, last_day)
    ).select("device_id", "reading_id", "timestamp_ts", "temperature", "humidity", "status", "data_quality_score")
    devices = t.device_metadata.select(
        "device_id", "device_name", "manufacturer", "model", "zone", "location", "floor", "sla_tier",
        "connectivity", "sampling_interval_sec", "alert_temp_min", "alert_temp_max",
        "alert_humidity_min", "alert_humidity_max",
    )
    leading = top_wide(readings.join(devices, "device_id"), k, "reading_id", "sla_tier", F.desc("timestamp_ts"), "reading_id")
    return leading.select(
        "device_id", "device_name", "manufacturer", "model", "zone", "location", "floor", "sla_tier",
        "connectivity", "sampling_interval_sec", "timestamp_ts", "temperature", "humidity", "status",
        "data_quality_score", "alert_temp_min", "alert_temp_max", "alert_humidity_min",
        "alert_humidity_max", threshold_alert().alias("threshold_alert"),
    )


def breach_figures(t: Tables) -> DataFrame:
    """Figures per device, breaches of its own thresholds among them.

    Breaches need the thresholds next to each reading, so this join comes
    before the grouping; the registry is broadcast or hot devices are split.
    """
    limits = t.device_metadata.select(
        "device_id", "alert_temp_min", "alert_temp_max", "alert_humidity_min", "alert_humidity_max"
    )
    readings = t.sensor_readings.select(
        "device_id", "reading_id", "timestamp_ts", "temperature", "humidity", "status", "data_quality_score"
    )
    return (
        skew_join(readings, limits, "device_id", ["reading_id"])
        .groupBy("device_id")
        .agg(
            F.count("reading_id").alias("n"),
            mean("temperature").alias("mean_temp"),
            F.min("temperature").alias("low_temp"),
            F.max("temperature").alias("high_temp"),
            mean("humidity").alias("mean_humidity"),
            mean("data_quality_score").alias("mean_quality"),
            count_where(temp_breach()).alias("temp_breaches"),
            count_where(humidity_breach()).alias("humidity_breaches"),
            count_where(F.col("status") == V.STATUS_OK).alias("ok"),
            F.min("timestamp_ts").alias("first_ts"),
            F.max("timestamp_ts").alias("last_ts"),
        )
    )


def device_health(t: Tables) -> DataFrame:
    """Health of every registered device, silent ones included."""
    zero = F.lit(0).cast("bigint")
    devices = t.device_metadata.select("device_id", "device_name", "zone", "sla_tier", "manufacturer")
    return (
        devices.join(breach_figures(t), "device_id", "left")
        .select(
            "device_id", "device_name", "zone", "sla_tier", "manufacturer",
            F.coalesce("n", zero).alias("total_readings"),
            half_up(F.col("mean_temp"), 2).alias("avg_temp"),
            half_up(F.col("low_temp"), 2).alias("min_temp"),
            half_up(F.col("high_temp"), 2).alias("max_temp"),
            half_up(F.col("mean_humidity"), 2).alias("avg_humidity"),
            half_up(F.col("mean_quality"), 3).alias("avg_quality_score"),
            F.coalesce("temp_breaches", zero).alias("temp_breach_count"),
            F.coalesce("humidity_breaches", zero).alias("humidity_breach_count"),
            half_up(percent(F.coalesce("ok", zero), F.coalesce("n", zero)), 2).alias("health_pct"),
        )
        .orderBy("sla_tier", "health_pct", "device_id")
    )


def zone_day_temps(t: Tables, day: str = "2024-01-15", zone: str = V.WATCHED_ZONE) -> DataFrame:
    """Mean temperature per device for one day and zone; prunes to one partition."""
    return (
        t.sensor_readings
        .filter((F.col("dt") == day) & (F.col("zone") == zone) & F.col("temperature").isNotNull())
        .groupBy("device_id")
        .agg(half_up(mean("temperature"), 2).alias("avg_temp"), rows().alias("readings"))
    )


def daily_device_report(t: Tables) -> DataFrame:
    """BI dataset: one row per day and device, with the device's attributes.

    Readings are grouped by day and device first; the join then sees one row
    for each, so no device weighs more than its days.
    """
    daily = (
        t.sensor_readings.filter(F.col("temperature").isNotNull())
        .groupBy("dt", "device_id")
        .agg(
            mean("temperature").alias("mean_c"),
            F.min("temperature").alias("low_c"),
            F.max("temperature").alias("high_c"),
            half_up(mean("humidity"), 2).alias("avg_humidity_pct"),
            F.count("reading_id").alias("reading_count"),
            count_where(F.col("status") == V.STATUS_ANOMALY).alias("anomaly_count"),
            count_where(F.col("status") == V.STATUS_MISSING).alias("missing_count"),
            mean("data_quality_score").alias("quality"),
        )
    )
    devices = t.device_metadata.select(
        "device_id", "device_name", "zone", "location", "floor", "manufacturer", "model", "sla_tier",
        "alert_temp_min", "alert_temp_max", "connectivity", "latitude", "longitude",
    )
    state = first_match(
        [
            (F.col("high_c") > F.col("alert_temp_max"), V.HIGH_TEMP_BREACH),
            (F.col("low_c") < F.col("alert_temp_min"), V.LOW_TEMP_BREACH),
            (F.col("quality") < V.LOW_QUALITY_BELOW, V.LOW_QUALITY),
        ],
        V.NORMAL,
    )
    return (
        daily.join(devices, "device_id")
        .select(
            F.col("dt").alias("reading_date"), "device_id", "device_name", "zone", "location", "floor",
            "manufacturer", "model", "sla_tier", "alert_temp_min", "alert_temp_max", "connectivity",
            "latitude", "longitude",
            half_up(F.col("mean_c"), 2).alias("avg_temperature_c"),
            half_up(F.col("low_c"), 2).alias("min_temperature_c"),
            half_up(F.col("high_c"), 2).alias("max_temperature_c"),
            half_up(F.col("mean_c") * 9 / 5 + 32, 2).alias("avg_temperature_f"),
            "avg_humidity_pct", "reading_count", "anomaly_count", "missing_count",
            half_up(F.col("quality") * 100, 1).alias("quality_score_pct"),
            state.alias("daily_status"),
        )
        .orderBy("reading_date", "zone", "device_id")
    )


def anomaly_rows(t: Tables, k: int = 10000) -> DataFrame:
    """The first anomalous readings by id, all columns."""
    return top_wide(t.sensor_readings.filter(F.col("status") == V.STATUS_ANOMALY), k, "reading_id", "reading_id")


def anomalies_with_device(t: Tables) -> DataFrame:
    """CSV report: anomalous readings with the context of their device."""
    readings = t.sensor_readings.filter((F.col("status") == V.STATUS_ANOMALY) | out_of_range()).drop("zone", "location")
    return (
        readings.join(t.device_metadata.select("device_id", "device_name", "zone", "location"), "device_id")
        .select(
            "reading_id", "device_id", "device_name", "zone", "location",
            F.col("timestamp_ts").alias("timestamp"), "temperature", "humidity", "status",
            first_match(range_reasons(), V.OTHER_ANOMALY).alias("anomaly_type"),
        )
        .orderBy(F.desc("timestamp"), "reading_id")
    )


def device_summary(t: Tables) -> DataFrame:
    """CSV report: every device with the figures of its readings."""
    zero = F.lit(0).cast("bigint")
    figures = t.sensor_readings.groupBy("device_id").agg(
        F.count("reading_id").alias("n"),
        half_up(mean("temperature"), 2).alias("avg_temp"),
        half_up(F.min("temperature"), 2).alias("min_temp"),
        half_up(F.max("temperature"), 2).alias("max_temp"),
        half_up(mean("humidity"), 2).alias("avg_humidity"),
        count_where(F.col("status") == V.STATUS_ANOMALY).alias("anomalies"),
        count_where(F.col("status") == V.STATUS_MISSING).alias("missing"),
    )
    devices = t.device_metadata.select(
        "device_id", "device_name", "manufacturer", "model", "zone", "location", "sla_tier",
        "alert_temp_min", "alert_temp_max", "connectivity",
    )
    return (
        devices.join(figures, "device_id", "left")
        .select(
            *devices.columns,
            F.coalesce("n", zero).alias("total_readings"),
            "avg_temp", "min_temp", "max_temp", "avg_humidity",
            F.coalesce("anomalies", zero).alias("anomaly_count"),
            F.coalesce("missing", zero).alias("missing_count"),
        )
        .orderBy("location", "zone", "device_id")
    )
