"""Raw sources to processed tables. Pure ``DataFrame -> DataFrame`` steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.labels import quality_score
from ..functions.measures import count_where, half_up, mean, rows
from ..functions.texts import (
    day, hashtag_tokens, log_time, request_method, request_protocol, request_target,
    target_part, typed, wall_clock,
)
from ..sources.raw import type_device, type_sensor, type_social


def web_traffic(raw: DataFrame) -> DataFrame:
    """Parsed log rows to web traffic; rows without ip, request or status go."""
    request = F.col("http_request")
    valid = raw.filter(
        F.col("client_ip").isNotNull() & request.isNotNull() & F.col("http_status").isNotNull()
    )
    size = F.when(F.col("response_bytes") == "-", F.lit(0).cast("bigint")).otherwise(typed("response_bytes", "bigint"))
    staged = valid.select(
        "client_ip", "http_request", "http_status", size.alias("response_bytes"), "referrer", "user_agent",
        request_target(request).alias("target"), log_time(F.col("raw_timestamp")).alias("request_ts"),
    )
    target, ts = F.col("target"), F.col("request_ts")
    return staged.select(
        "client_ip",
        request_method(request).alias("http_method"),
        target_part(target, 0).alias("url_path"),
        F.coalesce(target_part(target, 1), F.lit("")).alias("url_query"),
        request_protocol(request).alias("http_protocol"),
        "http_status",
        "response_bytes",
        "referrer",
        "user_agent",
        F.hour(ts).alias("request_hour"),
        F.dayofweek(ts).alias("request_dow"),
        "request_ts",
        day(ts).alias("dt"),
    )


def first_received(readings: DataFrame) -> DataFrame:
    """One row per device and time: the lowest reading id.

    ``row_number = 1`` lets Spark keep one row per key in each task before the
    shuffle, so a device that resends endlessly does not pile up in one task.
    """
    order = Window.partitionBy("device_id", "ts").orderBy("reading_id")
    return readings.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") == 1).drop("rn")


def keyed_readings(raw: DataFrame) -> DataFrame:
    """Typed readings that have an id, a device and a time."""
    return type_sensor(raw).filter(
        F.col("reading_id").isNotNull() & F.col("device_id").isNotNull() & F.col("ts").isNotNull()
    )


def scored_readings(readings: DataFrame) -> DataFrame:
    ts = wall_clock("ts")
    return readings.select(
        "reading_id", "device_id", "location", ts.alias("timestamp_ts"), "temperature", "humidity",
        "status", "is_duplicate", quality_score().alias("data_quality_score"), day(ts).alias("dt"), "zone",
    )


def sensor_readings(raw: DataFrame) -> DataFrame:
    return scored_readings(first_received(keyed_readings(raw)))


def social_posts(raw: DataFrame) -> DataFrame:
    posts = type_social(raw).filter(
        F.col("tweet_id").isNotNull() & F.col("username").isNotNull() & F.col("ts").isNotNull()
    )
    ts = wall_clock("ts")
    actions = F.col("likes") + F.col("retweets") + F.col("replies")
    rate = actions.cast("double") / F.greatest(F.col("impressions"), F.lit(1))
    return posts.select(
        "tweet_id", "username", "user_type", "followers", "verified", ts.alias("post_ts"), "post_text",
        "hashtags", F.size(hashtag_tokens(F.col("hashtags"))).alias("hashtag_count"),
        "likes", "retweets", "replies", "impressions", half_up(rate, 6).alias("engagement_rate"),
        "source", day(ts).alias("dt"), "language",
    )


def device_metadata(raw: DataFrame) -> DataFrame:
    return type_device(raw)


def sensor_daily_summary(readings: DataFrame, rounded: bool = True, need_humidity: bool = True) -> DataFrame:
    """Daily figures per device and zone, over readings that hold values.

    As both values must be there, ``missing_count`` counts only readings that
    are flagged MISSING yet carry values. The unrounded variant that asks for
    the temperature only is ``rounded=False, need_humidity=False``.
    """
    held = F.col("temperature").isNotNull()
    if need_humidity:
        held = held & F.col("humidity").isNotNull()
    average = (lambda c: half_up(mean(c), 4)) if rounded else mean
    return (
        readings.filter(held)
        .groupBy("device_id", "zone", "dt")
        .agg(
            average("temperature").alias("avg_temp"),
            F.min("temperature").alias("min_temp"),
            F.max("temperature").alias("max_temp"),
            average("humidity").alias("avg_humidity"),
            rows().alias("total_readings"),
            count_where(F.col("status") == V.STATUS_ANOMALY).alias("anomaly_count"),
            count_where(F.col("status") == V.STATUS_MISSING).alias("missing_count"),
        )
        .select("device_id", "zone", "avg_temp", "min_temp", "max_temp", "avg_humidity",
                "total_readings", "anomaly_count", "missing_count", "dt")
    )


def hashtag_mentions(posts: DataFrame) -> DataFrame:
    """One row per post and tag; tokens without ``#`` are no tags."""
    return posts.select("*", F.explode(hashtag_tokens(F.col("hashtags"))).alias("hashtag")).filter(
        F.col("hashtag").rlike("^#")
    )


def trending_hashtags_daily(posts: DataFrame) -> DataFrame:
    return (
        hashtag_mentions(posts)
        .groupBy("hashtag", "dt")
        .agg(
            rows().alias("mention_count"),
            F.sum("likes").alias("total_likes"),
            F.sum("retweets").alias("total_retweets"),
            half_up(mean("engagement_rate"), 6).alias("avg_engagement_rate"),
            F.min("post_ts").alias("first_seen"),
            F.max("post_ts").alias("last_seen"),
        )
        .select("hashtag", "mention_count", "total_likes", "total_retweets",
                "avg_engagement_rate", "first_seen", "last_seen", "dt")
    )
