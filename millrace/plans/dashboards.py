"""Datasets behind the dashboards, web, sensors, social and across sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.labels import first_match, no_reading, status_class
from ..functions.measures import count_where, half_up, mean, percent, rows
from ..operators.toplists import top
from ..tables import Tables
from .sensors import breach_figures
from .social import top_hashtags



def _none():
    return F.lit(0).cast("bigint")


# -- web ---------------------------------------------------------------


def status_distribution(t: Tables) -> DataFrame:
    """Requests by hour and status class, and their share of all requests."""
    counts = (
        t.web_traffic.groupBy("request_hour", status_class(F.col("http_status")).alias("status_class"))
        .agg(rows().alias("requests"))
    )
    # At most 24 hours by five classes go through this window.
    everything = Window.partitionBy(F.lit(1))
    share = half_up(F.col("requests") * 100.0 / F.sum("requests").over(everything), 4)
    return counts.withColumn("share_pct", share).orderBy("request_hour", "status_class")


def top_pages(t: Tables, k: int = 15) -> DataFrame:
    views = t.web_traffic.filter(~F.col("url_path").isin(V.NOISE_PATHS)).groupBy("url_path").agg(rows().alias("page_views"))
    return top(views, k, F.desc("page_views"), "url_path")


def ip_regions(t: Tables) -> DataFrame:
    """Requests and visitors by address block. This is no geolocation."""
    ip = F.col("client_ip")
    block = first_match(
        [
            (ip.startswith("192.168."), "block_192_168"),
            (ip.startswith("10."), "block_10"),
            (ip.rlike(r"^172\.(1[6-9]|2[0-9]|3[01])\."), "block_172_16"),
        ],
        "public",
    )
    return (
        t.web_traffic.groupBy(block.alias("region"))
        .agg(rows().alias("requests"), F.countDistinct("client_ip").alias("unique_ips"))
        .orderBy("region")
    )


# -- sensors -----------------------------------------------------------


def temperature_by_hour(t: Tables) -> DataFrame:
    """Mean temperature and humidity per device and hour."""
    return (
        t.sensor_readings.groupBy("device_id", F.date_trunc("hour", "timestamp_ts").cast("timestamp_ntz").alias("hour_start"))
        .agg(
            half_up(mean("temperature"), 2).alias("avg_temp"),
            half_up(mean("humidity"), 2).alias("avg_humidity"),
            rows().alias("readings"),
        )
        .orderBy("device_id", "hour_start")
    )


def current_status(t: Tables) -> DataFrame:
    """Latest reading per device; of equal times the higher id."""
    columns = ("device_id", "reading_id", "zone", "timestamp_ts", "temperature", "humidity", "status", "data_quality_score")
    # A time has a fixed width, so the fact is hashed, not sorted; then few rows are left.
    last = t.sensor_readings.groupBy(F.col("device_id").alias("_id")).agg(F.max("timestamp_ts").alias("_last"))
    at_last = t.sensor_readings.select(*columns).join(last, (F.col("device_id") == F.col("_id")) & (F.col("timestamp_ts") == F.col("_last")))
    place = F.row_number().over(Window.partitionBy("device_id").orderBy(F.desc("reading_id")))
    return at_last.withColumn("_place", place).filter("_place = 1").select(*columns).orderBy("device_id")


def temp_humidity_scatter(t: Tables) -> DataFrame:
    """Every reading that holds both values, with its anomaly flag."""
    return t.sensor_readings.filter(~no_reading()).select(
        "device_id", "timestamp_ts", "temperature", "humidity",
        (F.col("status") == V.STATUS_ANOMALY).alias("is_anomaly"),
    )


def device_scorecard(t: Tables) -> DataFrame:
    """Uptime, mean temperature and alerts per device.

    Uptime is the number of OK readings in percent of those expected between
    the first and last reading at the device's sampling interval; a device that
    sends too often shows more than 100.
    """
    seconds = F.unix_seconds(F.col("last_ts").cast("timestamp")) - F.unix_seconds(F.col("first_ts").cast("timestamp"))
    expected = F.floor(seconds / F.greatest(F.col("sampling_interval_sec"), F.lit(1))) + 1
    ok = F.coalesce("ok", _none())
    uptime = percent(ok, F.coalesce("expected", _none()))
    return (
        t.device_metadata.select("device_id", "device_name", "sla_tier", "sampling_interval_sec")
        .join(breach_figures(t), "device_id", "left")
        .withColumn("expected", expected.cast("bigint"))
        .select(
            "device_id", "device_name", "sla_tier",
            ok.alias("ok_readings"),
            F.coalesce("expected", _none()).alias("expected_readings"),
            half_up(uptime, 2).alias("uptime_pct"),
            half_up(F.col("mean_temp"), 2).alias("avg_temp"),
            (F.coalesce("temp_breaches", _none()) + F.coalesce("humidity_breaches", _none())).alias("alert_count"),
        )
        .orderBy("device_id")
    )


def location_heat(t: Tables) -> DataFrame:
    """Readings and mean temperature per location and zone, at the mean position of the devices."""
    per_device = t.sensor_readings.groupBy("device_id").agg(
        rows().alias("n"), F.sum("temperature").alias("temp_sum"), F.count("temperature").alias("temp_n")
    )
    return (
        t.device_metadata.select("device_id", "location", "zone", "latitude", "longitude")
        .join(per_device, "device_id", "left")
        .groupBy("location", "zone")
        .agg(
            half_up(mean("latitude"), 4).alias("latitude"),
            half_up(mean("longitude"), 4).alias("longitude"),
            rows().alias("devices"),
            F.coalesce(F.sum("n"), _none()).alias("readings"),
            half_up(F.try_divide(F.sum("temp_sum"), F.sum("temp_n")), 2).alias("avg_temp"),
        )
        .orderBy("location", "zone")
    )


def sla_compliance(t: Tables) -> DataFrame:
    """Share of OK readings per device against the target of its service tier."""
    per_device = t.sensor_readings.groupBy("device_id").agg(
        rows().alias("n"), count_where(F.col("status") == V.STATUS_OK).alias("ok")
    )
    n, ok = F.coalesce("n", _none()), F.coalesce("ok", _none())
    target = first_match([(F.col("sla_tier") == tier, F.lit(goal)) for tier, goal in V.SLA_TARGETS.items()])
    health = half_up(percent(ok, n), 2)
    return (
        t.device_metadata.select("device_id", "device_name", "sla_tier")
        .join(per_device, "device_id", "left")
        .select(
            "device_id", "device_name", "sla_tier", n.alias("total_readings"), health.alias("health_pct"),
            target.alias("target_pct"), (health >= target).alias("compliant"),
        )
        .orderBy("sla_tier", "device_id")
    )


# -- social ------------------------------------------------------------


def engagement_timeline(t: Tables) -> DataFrame:
    """Likes and retweets per day and summed up to the day."""
    daily = t.social_posts.groupBy("dt").agg(F.sum("likes").alias("likes"), F.sum("retweets").alias("retweets"))
    # One row per calendar day goes through this window.
    so_far = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "dt", "likes", "retweets",
        F.sum("likes").over(so_far).alias("cumulative_likes"),
        F.sum("retweets").over(so_far).alias("cumulative_retweets"),
    ).orderBy("dt")


def word_frequency(t: Tables, k: int = 100) -> DataFrame:
    """Most frequent words of the whole post texts, in lower case."""
    words = t.social_posts.select(F.explode(F.split(F.lower("post_text"), r"[^\p{L}\p{N}]+")).alias("word"))
    counts = words.filter(F.col("word") != "").groupBy("word").agg(rows().alias("frequency"))
    return top(counts, k, F.desc("frequency"), "word")


def influencers(t: Tables) -> DataFrame:
    """Users by reach: followers times posts."""
    return (
        t.social_posts.groupBy("username")
        .agg(
            F.max("followers").alias("followers"),
            F.count("tweet_id").alias("posts"),
            half_up(mean("engagement_rate") * 100, 4).alias("avg_engagement_pct"),
        )
        .withColumn("reach", F.col("followers") * F.col("posts"))
        .orderBy(F.desc("reach"), "username")
    )


def posts_by_type_day(t: Tables) -> DataFrame:
    return t.social_posts.groupBy("dt", "user_type").agg(rows().alias("posts")).orderBy("dt", "user_type")


# -- across sources ----------------------------------------------------


def executive_kpis(t: Tables) -> DataFrame:
    """One row per day and source."""
    shape = {
        "dt": "string", "data_source": "string", "record_count": "bigint", "anomaly_count": "bigint",
        "anomaly_rate_pct": "double", "total_data_bytes": "bigint",
    }

    def part(daily: DataFrame, source: str) -> DataFrame:
        present = set(daily.columns)
        return daily.withColumn("data_source", F.lit(source)).select(
            *[(F.col(n) if n in present | {"data_source"} else F.lit(0)).cast(kind).alias(n) for n, kind in shape.items()]
        )

    web = t.web_traffic.groupBy("dt").agg(
        rows().alias("record_count"), F.sum("response_bytes").alias("total_data_bytes")
    )
    anomalies, readings = F.sum("anomaly_count"), F.sum("total_readings")
    sensors = t.sensor_daily_summary.groupBy("dt").agg(
        readings.alias("record_count"),
        half_up(percent(anomalies, readings), 3).alias("anomaly_rate_pct"),
        anomalies.alias("anomalies"),
    ).withColumnRenamed("anomalies", "anomaly_count")
    social = t.social_posts.groupBy("dt").agg(F.count("tweet_id").alias("record_count"))
    return (
        part(web, V.SOURCE_WEB)
        .unionByName(part(sensors, V.SOURCE_SENSORS))
        .unionByName(part(social, V.SOURCE_SOCIAL))
        .orderBy("dt", "data_source")
    )


def kpi_cards(t: Tables) -> DataFrame:
    """One row: readings, anomaly rate, most mentioned hashtag, busiest hour."""
    sensors = t.sensor_daily_summary.agg(
        F.sum("total_readings").alias("total_readings"),
        half_up(percent(F.sum("anomaly_count"), F.sum("total_readings")), 3).alias("anomaly_rate_pct"),
    )
    tag = top_hashtags(t, 1, "mentions").select(F.col("hashtag").alias("top_hashtag"))
    hours = t.web_traffic.groupBy("request_hour").agg(rows().alias("n"))
    hour = top(hours, 1, F.desc("n"), "request_hour").select(F.col("request_hour").alias("peak_hour"))
    # Three one-row results, brought into one row.
    cards = sensors.unionByName(tag, allowMissingColumns=True).unionByName(hour, allowMissingColumns=True)
    return cards.agg(*[F.max(c).alias(c) for c in cards.columns])


def requests_vs_anomalies(t: Tables) -> DataFrame:
    """Web requests and sensor anomalies by day."""
    web = t.web_traffic.groupBy("dt").agg(rows().alias("web_requests"))
    sensors = t.sensor_daily_summary.groupBy("dt").agg(F.sum("anomaly_count").alias("sensor_anomalies"))
    return (
        web.join(sensors, "dt", "full_outer")
        .select(
            "dt", F.coalesce("web_requests", _none()).alias("web_requests"),
            F.coalesce("sensor_anomalies", _none()).alias("sensor_anomalies"),
        )
        .orderBy("dt")
    )


def volume_by_source(t: Tables) -> DataFrame:
    """Records and bytes per source."""
    return (
        executive_kpis(t).groupBy("data_source")
        .agg(F.sum("record_count").alias("record_count"), F.sum("total_data_bytes").alias("total_data_bytes"))
        .orderBy("data_source")
    )
