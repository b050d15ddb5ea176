"""Load checks: what an operator looks at after each load step."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import rows
from ..operators.sampling import sampled
from ..operators.toplists import top
from ..tables import Tables


def log_sample(raw_logs: DataFrame, k: int = 5) -> DataFrame:
    """Some parsed log rows, in no particular order: how many come, and how many of them the table holds."""
    return sampled(raw_logs.select("client_ip", "raw_timestamp", "http_request", "http_status", "response_bytes"), k)


def status_counts(raw_readings: DataFrame) -> DataFrame:
    return raw_readings.groupBy("status").agg(rows().alias("cnt"))


def user_type_counts(raw_posts: DataFrame) -> DataFrame:
    return raw_posts.groupBy("user_type").agg(rows().alias("post_count")).orderBy(F.desc("post_count"))


def device_list(raw_devices: DataFrame) -> DataFrame:
    return raw_devices.select("device_id", "device_name", "zone", "sla_tier", "connectivity").orderBy(
        F.desc("sla_tier"), "zone", "device_id"
    )


def web_by_day(t: Tables, k: int = 10) -> DataFrame:
    daily = t.web_traffic.groupBy("dt").agg(
        rows().alias("row_count"), F.countDistinct("client_ip").alias("unique_ips")
    )
    return top(daily, k, F.asc_nulls_first("dt"))


def sensor_by_day_zone(t: Tables, k: int = 20) -> DataFrame:
    counts = t.sensor_readings.groupBy("dt", "zone").agg(rows().alias("readings"))
    return top(counts, k, F.asc_nulls_first("dt"), F.asc_nulls_first("zone"))


def social_by_language_day(t: Tables, k: int = 10) -> DataFrame:
    counts = t.social_posts.groupBy("language", "dt").agg(rows().alias("posts"))
    return top(counts, k, F.asc_nulls_first("dt"), F.asc_nulls_first("language"))


def devices_loaded(t: Tables) -> DataFrame:
    return t.device_metadata.select("device_id", "zone", "sla_tier", "connectivity").orderBy("device_id")
