"""Web traffic analytics.

Results sort by their unique columns last, here and in the other plans: the
order is then the same in every run, and a sort can split equal values over
tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.labels import day_name, status_class
from ..functions.measures import count_where, half_up, mean, percent, rows
from ..operators.toplists import top
from ..tables import Tables



def hourly_status(t: Tables) -> DataFrame:
    """Requests, visitors and bytes by hour and status class."""
    return (
        t.web_traffic
        .withColumn("status_class", status_class(F.col("http_status")))
        .groupBy("request_hour", "status_class")
        .agg(
            rows().alias("total_requests"),
            F.countDistinct("client_ip").alias("unique_visitors"),
            F.sum("response_bytes").alias("total_bytes_served"),
            half_up(mean("response_bytes"), 0).alias("avg_response_size_bytes"),
            F.min("http_status").alias("min_status_code"),
            F.max("http_status").alias("max_status_code"),
        )
        .orderBy("request_hour", F.desc("total_requests"), "status_class")
    )


def top_urls(t: Tables, k: int = 20, at_least: int = V.MIN_PATH_REQUESTS) -> DataFrame:
    """Most requested paths with their error rates, noise paths left out."""
    status = F.col("http_status")
    per_path = (
        t.web_traffic.filter(~F.col("url_path").isin(V.NOISE_PATHS))
        .groupBy("url_path")
        .agg(
            rows().alias("total_requests"),
            count_where(status == 200).alias("success_count"),
            count_where(status == 404).alias("not_found_count"),
            count_where(status >= 500).alias("server_error_count"),
            half_up(percent(count_where(status >= 400), rows()), 2).alias("error_rate_pct"),
            F.sum("response_bytes").alias("total_bytes"),
            half_up(mean("response_bytes"), 0).alias("avg_response_bytes"),
        )
        .filter(F.col("total_requests") >= at_least)
    )
    return top(per_path, k, F.desc("total_requests"), "url_path")


def heatmap(t: Tables) -> DataFrame:
    """Requests by hour and weekday."""
    return (
        t.web_traffic
        .groupBy(F.col("request_hour").alias("hour_of_day"), F.col("request_dow").alias("day_of_week"))
        .agg(rows().alias("request_count"), F.countDistinct("client_ip").alias("unique_ips"))
        .withColumn("day_name", day_name(F.col("day_of_week")))
        .select("hour_of_day", "day_of_week", "day_name", "request_count", "unique_ips")
        .orderBy("day_of_week", "hour_of_day")
    )


def day_top_urls(t: Tables, day: str = "2024-01-15", status: int = 200, k: int = 10) -> DataFrame:
    """Top paths of one day and status; prunes to the day's partition."""
    per_path = (
        t.web_traffic.filter((F.col("dt") == day) & (F.col("http_status") == status))
        .groupBy("url_path", "http_status")
        .agg(rows().alias("total_requests"), F.sum("response_bytes").alias("total_bytes"))
    )
    return top(per_path, k, F.desc("total_requests"), "url_path")


def hourly_paths(t: Tables) -> DataFrame:
    """BI dataset: one row per day, hour, status code, method and path.

    The column ``total_bytes_mb`` holds bytes, as its readers expect.
    """
    return (
        t.web_traffic
        .groupBy("dt", "request_hour", "request_dow", "http_status", "http_method", "url_path")
        .agg(
            rows().alias("request_count"),
            F.countDistinct("client_ip").alias("unique_visitors"),
            F.sum("response_bytes").alias("total_bytes_mb"),
            half_up(mean("response_bytes") / 1024, 2).alias("avg_response_kb"),
        )
        .select(
            F.col("dt").alias("date"),
            F.col("request_hour").alias("hour_of_day"),
            F.col("request_dow").alias("day_of_week"),
            day_name(F.col("request_dow")).alias("day_name"),
            status_class(F.col("http_status"), V.STATUS_CLASSES_BI).alias("status_class"),
            "http_method", "url_path", "request_count", "unique_visitors", "total_bytes_mb", "avg_response_kb",
        )
        .orderBy("date", "hour_of_day", F.desc("request_count"), "url_path", "http_method", "status_class")
    )


def hourly_path_status(t: Tables) -> DataFrame:
    """CSV report: traffic by hour, path and status code."""
    return (
        t.web_traffic.groupBy("request_hour", "url_path", "http_status")
        .agg(
            rows().alias("total_requests"),
            F.sum("response_bytes").alias("total_bytes"),
            F.countDistinct("client_ip").alias("unique_visitors"),
            half_up(mean("response_bytes"), 2).alias("avg_response_bytes"),
        )
        .orderBy("request_hour", F.desc("total_requests"), "url_path", "http_status")
    )
