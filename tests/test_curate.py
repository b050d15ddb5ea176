"""Scores, duplicates, daily summaries and reasons on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.labels import anomaly_reason, status_class, threshold_alert
from millrace.functions.measures import half_up, mean
from millrace.plans import curate, dashboards, rollups, sensors, social, web
from millrace.tables import Tables

RAW = "reading_id string, device_id string, location string, zone string, ts string, temperature string, humidity string, status string, is_duplicate string"


def raw_readings(spark, *rows):
    """Rows of (id, device, ts, temperature, humidity, status, flag)."""
    full = [(str(i) if i is not None else None, d, "B", "lab", ts, t, h, s, f) for i, d, ts, t, h, s, f in rows]
    return spark.createDataFrame(full, RAW)


def tables(**frames):
    return Tables(frames.__getitem__)


TS = "2024-01-15 09:30:00"


@pytest.mark.parametrize(
    "temperature, humidity, status, flag, score",
    [
        ("20", "50", "OK", "False", 1.0), ("85", "50", "OK", "False", 1.0), ("85.01", "50", "OK", "False", 0.25),
        ("-30", "50", "OK", "False", 1.0), ("-30.01", "50", "OK", "False", 0.25), ("20", "50", "OK", "True", 0.5),
        ("20", "50", "ANOMALY", "True", 0.0), ("", "", "MISSING", "False", 0.0), ("", "50", "OK", "False", 0.0),
        ("90", "50", "OK", "True", 0.5), ("20", "50", None, None, 1.0),
    ],
)
def test_quality_score(spark, temperature, humidity, status, flag, score):
    df = curate.sensor_readings(raw_readings(spark, (1, "D", TS, temperature, humidity, status, flag)))
    assert df.first().data_quality_score == score


def test_first_received_wins_and_keys_must_be_there(spark):
    df = curate.sensor_readings(raw_readings(
        spark, (9, "D", TS, "1", "1", "OK", "False"), (10, "D", TS, "2", "2", "OK", "False"),
        (100, "D", TS, "3", "3", "OK", "False"), (11, "E", TS, "4", "4", "OK", "False"),
        (None, "D", "2024-01-15 10:00:00", "5", "5", "OK", "False"), (12, None, TS, "6", "6", "OK", "False"),
        (13, "D", None, "7", "7", "OK", "False"),
    ))
    assert sorted((r.reading_id, r.device_id) for r in df.collect()) == [(9, "D"), (11, "E")]


@pytest.mark.parametrize(
    "temperature, humidity, reason",
    [
        (None, 5.0, "MISSING_READING"), (5.0, None, "MISSING_READING"), (100.1, 101.0, "EXTREME_HIGH_TEMP"),
        (-40.1, 50.0, "EXTREME_LOW_TEMP"), (20.0, 100.1, "INVALID_HUMIDITY_HIGH"), (20.0, -0.1, "INVALID_HUMIDITY_LOW"),
        (85.1, 50.0, "HIGH_TEMP_WARNING"), (-20.1, 50.0, "LOW_TEMP_WARNING"), (85.0, 0.0, "UNSPECIFIED_ANOMALY"),
        (100.0, 100.0, "HIGH_TEMP_WARNING"), (-40.0, 0.0, "LOW_TEMP_WARNING"),
    ],
)
def test_anomaly_reason(spark, temperature, humidity, reason):
    df = spark.createDataFrame([(temperature, humidity)], "temperature double, humidity double")
    assert df.select(anomaly_reason()).first()[0] == reason


def test_bounds_themselves_are_no_anomaly(spark):
    readings = curate.sensor_readings(raw_readings(
        spark, (1, "D", TS, "100", "100", "OK", "False"), (2, "D", "2024-01-15 10:00:00", "-40", "0", "OK", "False"),
        (3, "D", "2024-01-15 11:00:00", "100.01", "50", "ANOMALY", "False"),
    ))
    rows = sensors.anomaly_types(tables(sensor_readings=readings)).collect()
    assert [(r.anomaly_type, r.occurrence_count, r.max_temp_observed) for r in rows] == [("EXTREME_HIGH_TEMP", 1, 100.01)]


def test_daily_summary_leaves_missing_out(spark):
    readings = curate.sensor_readings(raw_readings(
        spark, (1, "D", TS, "10", "50", "OK", "False"), (2, "D", "2024-01-15 10:00:00", "", "", "MISSING", "False"),
        (3, "D", "2024-01-15 11:00:00", "11", "", "ANOMALY", "False"),
    ))
    row = curate.sensor_daily_summary(readings).first()
    assert (row.total_readings, row.anomaly_count, row.missing_count, row.avg_temp) == (1, 0, 0, 10.0)
    variant = curate.sensor_daily_summary(readings, rounded=False, need_humidity=False).first()
    assert (variant.total_readings, variant.anomaly_count, variant.avg_temp, variant.avg_humidity) == (2, 1, 10.5, 50.0)


SOCIAL = ("tweet_id string, username string, user_type string, followers string, verified string, ts string, post_text string, "
          "hashtags string, likes string, retweets string, replies string, impressions string, language string, source string")


def posts(spark, *rows):
    """Rows of (id, ts, hashtags, likes, impressions)."""
    full = [(str(i), "u", "nano", "1", "False", ts, "t", tags, str(likes), "0", "0", str(seen), "en", "web") for i, ts, tags, likes, seen in rows]
    return curate.social_posts(spark.createDataFrame(full, SOCIAL))


def test_engagement_and_hashtag_count(spark):
    df = posts(spark, (1, TS, "", 7, 0), (2, TS, "#a  #b", 1, 3), (3, TS, "plain", 0, 5))
    got = {r.tweet_id: (r.hashtag_count, r.engagement_rate) for r in df.collect()}
    assert got == {1: (1, 7.0), 2: (2, 0.333333), 3: (1, 0.0)}


def test_only_tags_are_mentioned(spark):
    rows = curate.trending_hashtags_daily(posts(spark, (1, TS, "#a plain #b", 1, 1), (2, TS, "", 1, 1), (3, TS, "#a", 2, 1))).collect()
    assert {r.hashtag: (r.mention_count, r.total_likes) for r in rows} == {"#a": (2, 3), "#b": (1, 1)}


def daily_tags(spark, *rows):
    full = [(tag, n, 0, 0, 0.0, None, None, day) for tag, day, n in rows]
    return tables(trending_hashtags_daily=spark.createDataFrame(
        full, "hashtag string, mention_count bigint, total_likes bigint, total_retweets bigint, avg_engagement_rate double, "
              "first_seen timestamp_ntz, last_seen timestamp_ntz, dt string"))


def test_trend_delta_starts_from_nothing(spark):
    t = daily_tags(spark, ("#a", "2024-01-01", 4), ("#a", "2024-01-03", 6))
    got = [(r.dt, r.prev_day_mentions, r.daily_delta, r.growth_rate_pct) for r in social.trend_delta(t).collect()]
    assert got == [("2024-01-01", 0, 4, 100.0), ("2024-01-03", 4, 2, 50.0)]


def test_rank_comparison_with_ties(spark):
    t = daily_tags(spark, *[(f"#{c}", "2024-01-01", n) for c, n in zip("abcde", (5, 9, 5, 1, 5))])
    got = [(r.hashtag, r.mention_rank, r.dense_rank, r.row_num, r.percentile) for r in social.rank_comparison(t).collect()]
    assert got == [("#b", 1, 1, 1, 0.0), ("#a", 2, 2, 2, 0.25), ("#c", 2, 2, 3, 0.25), ("#e", 2, 2, 4, 0.25), ("#d", 5, 3, 5, 1.0)]
    assert social.rank_comparison(t, k=1).count() == 1


def test_percent_rank_of_a_single_row_is_zero(spark):
    assert social.rank_comparison(daily_tags(spark, ("#a", "2024-01-01", 3))).first().percentile == 0.0


def test_overall_rank_counts_rows_and_seven_rows_skip_gaps(spark):
    days = [f"2024-01-{d:02}" for d in (1, 2, 3, 4, 5, 6, 20, 21)]
    t = daily_tags(spark, *[("#a", d, 1) for d in days], ("#b", "2024-01-01", 2))
    rows = {(r.hashtag, r.trend_date): r for r in social.hashtag_trends(t).collect()}
    assert {rows["#a", d].overall_rank for d in days} == {1}
    assert rows["#b", "2024-01-01"].overall_rank == 9
    assert rows["#a", "2024-01-21"].rolling_7d_mentions == 7
    assert rows["#b", "2024-01-01"].daily_rank == 1 and rows["#a", "2024-01-01"].daily_rank == 2


def device(spark, *ids):
    return spark.createDataFrame(
        [(i, i, "lab", "GOLD", "m", 0.0, 30.0, 20.0, 80.0, 3600) for i in ids],
        "device_id string, device_name string, zone string, sla_tier string, manufacturer string, alert_temp_min double, "
        "alert_temp_max double, alert_humidity_min double, alert_humidity_max double, sampling_interval_sec int")


def test_silent_device_and_unknown_device(spark):
    readings = curate.sensor_readings(raw_readings(
        spark, (1, "D", TS, "31", "50", "OK", "False"), (2, "D", "2024-01-15 10:30:00", "10", "10", "ANOMALY", "False"),
        (3, "X", TS, "10", "50", "OK", "False"),
    ))
    t = tables(sensor_readings=readings, device_metadata=device(spark, "D", "S"))
    got = {r.device_id: r for r in sensors.device_health(t).collect()}
    assert set(got) == {"D", "S"}
    assert (got["D"].total_readings, got["D"].temp_breach_count, got["D"].humidity_breach_count, got["D"].health_pct) == (2, 1, 1, 50.0)
    assert (got["S"].total_readings, got["S"].avg_temp, got["S"].temp_breach_count, got["S"].health_pct) == (0, None, 0, 0.0)
    card = {r.device_id: r for r in dashboards.device_scorecard(t).collect()}
    assert (card["D"].expected_readings, card["D"].uptime_pct, card["D"].alert_count) == (2, 50.0, 2)
    assert (card["S"].expected_readings, card["S"].uptime_pct) == (0, 0.0)


@pytest.mark.parametrize(
    "temperature, humidity, text",
    [
        (-0.5, 50.0, "TEMP_TOO_LOW (-0.5°C < 0.0°C threshold)"), (31.25, 10.0, "TEMP_TOO_HIGH (31.25°C > 30.0°C threshold)"),
        (20.0, 19.9, "HUMIDITY_TOO_LOW (19.9% < 20.0% threshold)"), (20.0, 80.1, "HUMIDITY_TOO_HIGH (80.1% > 80.0% threshold)"),
        (0.0, 20.0, "WITHIN_THRESHOLD"), (None, 50.0, "WITHIN_THRESHOLD"),
    ],
)
def test_threshold_alert(spark, temperature, humidity, text):
    df = spark.createDataFrame(
        [(temperature, humidity, 0.0, 30.0, 20.0, 80.0)],
        "temperature double, humidity double, alert_temp_min double, alert_temp_max double, alert_humidity_min double, alert_humidity_max double")
    assert df.select(threshold_alert()).first()[0] == text


def test_path_needs_ten_requests(spark):
    rows = [("/nine", 200)] * 9 + [("/ten", 200)] * 9 + [("/ten", 404)] + [("/robots.txt", 200)] * 30
    web_rows = spark.createDataFrame(rows, "url_path string, http_status int").withColumn("response_bytes", F.lit(10).cast("bigint"))
    got = [(r.url_path, r.total_requests, r.not_found_count, r.error_rate_pct) for r in web.top_urls(tables(web_traffic=web_rows)).collect()]
    assert got == [("/ten", 10, 1, 10.0)]


def test_status_class_bounds(spark):
    df = spark.createDataFrame([(s,) for s in (199, 200, 299, 300, 499, 500, 599, 600, None)], "s int")
    got = [r[0] for r in df.select(status_class(F.col("s"))).collect()]
    assert got == ["Unknown", "2xx_Success", "2xx_Success", "3xx_Redirect", "4xx_Client_Error", "5xx_Server_Error",
                   "5xx_Server_Error", "Unknown", "Unknown"]


def test_null_zone_is_not_the_total(spark):
    daily = spark.createDataFrame(
        [("D", None, 1.0, 1.0, 1.0, 1.0, 1, 0, 0, "2024-01-01"), ("D", "lab", 3.0, 3.0, 3.0, 3.0, 1, 1, 0, "2024-01-01")],
        "device_id string, zone string, avg_temp double, min_temp double, max_temp double, avg_humidity double, "
        "total_readings bigint, anomaly_count bigint, missing_count bigint, dt string")
    rows = rollups.grouping_sets(tables(sensor_daily_summary=daily)).collect()
    days = [r for r in rows if r.date_key == "2024-01-01" and r.device_key == "ALL_DEVICES"]
    assert {(r.zone_key, r.total_readings) for r in days} == {(None, 1), ("lab", 1), ("ALL_ZONES", 2)}


def test_weeks_of_two_years_share_a_number(spark):
    daily = spark.createDataFrame(
        [("D", "lab", 1.0, 1.0, 1.0, 1.0, 1, 0, 0, d) for d in ("2023-01-03", "2024-01-02", "2024-12-30")],
        "device_id string, zone string, avg_temp double, min_temp double, max_temp double, avg_humidity double, "
        "total_readings bigint, anomaly_count bigint, missing_count bigint, dt string")
    t = tables(sensor_daily_summary=daily)
    (row,) = rollups.weekly(t).collect()
    assert (row.week_number, row.weekly_readings, row.week_start_date, row.week_end_date) == (1, 3, "2023-01-03", "2024-12-30")
    assert [(r.iso_year, r.weekly_readings) for r in rollups.weekly(t, with_year=True).collect()] == [(2023, 1), (2024, 1), (2025, 1)]


def test_rounding_is_half_up_and_keeps_odd_values(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (float("nan"),), (1e300,), (None,)], "x double")
    got = [r[0] for r in df.select(half_up(F.col("x"), 2)).collect()]
    assert got[:3] == [1.01, 2.68, -1.01] and got[3] != got[3] and got[4:] == [1e300, None]
    assert df.filter("x is null").agg(mean("x")).first()[0] is None
