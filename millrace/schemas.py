"""Declared schemas of the raw files and the processed tables.

Schemas are never inferred. Raw CSV columns bind by position and arrive as
text; the curate plans give them their types.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _all_text(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


RAW_WEB_COLUMNS = (
    "client_ip rfc_ident auth_user raw_timestamp http_request "
    "http_status response_bytes referrer user_agent"
).split()

RAW_SENSOR = _all_text(
    "reading_id device_id location zone ts temperature humidity status is_duplicate"
)

RAW_SOCIAL = _all_text(
    "tweet_id username user_type followers verified ts post_text hashtags "
    "likes retweets replies impressions language source"
)

RAW_DEVICE = _all_text(
    "device_id device_name model firmware_version manufacturer location floor zone "
    "latitude longitude install_date last_maintenance battery_level_pct connectivity "
    "sampling_interval_sec alert_temp_min alert_temp_max alert_humidity_min "
    "alert_humidity_max active cost_center sla_tier"
)

# Column lists of the processed tables, partition columns last.
WEB_TRAFFIC = (
    "client_ip string, http_method string, url_path string, url_query string, "
    "http_protocol string, http_status int, response_bytes bigint, referrer string, "
    "user_agent string, request_hour int, request_dow int, request_ts timestamp_ntz, dt string"
)

SENSOR_READINGS = (
    "reading_id bigint, device_id string, location string, timestamp_ts timestamp_ntz, "
    "temperature double, humidity double, status string, is_duplicate boolean, "
    "data_quality_score double, dt string, zone string"
)

SOCIAL_POSTS = (
    "tweet_id bigint, username string, user_type string, followers bigint, verified boolean, "
    "post_ts timestamp_ntz, post_text string, hashtags string, hashtag_count int, likes bigint, "
    "retweets bigint, replies bigint, impressions bigint, engagement_rate double, source string, "
    "dt string, language string"
)

DEVICE_METADATA = (
    "device_id string, device_name string, model string, firmware_version string, "
    "manufacturer string, location string, floor string, zone string, latitude double, "
    "longitude double, install_date date, last_maintenance date, battery_level_pct int, "
    "connectivity string, sampling_interval_sec int, alert_temp_min double, "
    "alert_temp_max double, alert_humidity_min double, alert_humidity_max double, "
    "active boolean, cost_center string, sla_tier string"
)

SENSOR_DAILY_SUMMARY = (
    "device_id string, zone string, avg_temp double, min_temp double, max_temp double, "
    "avg_humidity double, total_readings bigint, anomaly_count bigint, missing_count bigint, "
    "dt string"
)

TRENDING_HASHTAGS_DAILY = (
    "hashtag string, mention_count bigint, total_likes bigint, total_retweets bigint, "
    "avg_engagement_rate double, first_seen timestamp_ntz, last_seen timestamp_ntz, dt string"
)

PROCESSED = {
    "web_traffic": _schema(WEB_TRAFFIC),
    "sensor_readings": _schema(SENSOR_READINGS),
    "social_posts": _schema(SOCIAL_POSTS),
    "device_metadata": _schema(DEVICE_METADATA),
    "sensor_daily_summary": _schema(SENSOR_DAILY_SUMMARY),
    "trending_hashtags_daily": _schema(TRENDING_HASHTAGS_DAILY),
}

# One row per piece of an archived file.
MANIFEST = _schema(
    "name string, bytes bigint, modified bigint, piece int, start bigint, length bigint, sha256 string, stored string"
)
