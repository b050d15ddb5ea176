"""DuckDB SQL for every registered query whose result is fully determined."""

from __future__ import annotations

from .views import big, pick, rnd, with_views

WEB, SENSORS, POSTS, DEVICES = "web_traffic", "sensor_readings", "social_posts", "device_metadata"
DAILY, TAGS, LOGS, SENDINGS, TYPED = "sensor_daily_summary", "trending_hashtags_daily", "logs", "sendings", "typed_sendings"

DAY_NAME = pick("Sunday Monday Tuesday Wednesday Thursday Friday Saturday", "request_dow - 1")
NOISE = "('/favicon.ico', '/robots.txt', '/sitemap.xml')"


def status_class(two: str, three: str, four: str, five: str) -> str:
    return (
        f"CASE http_status // 100 WHEN 2 THEN '{two}' WHEN 3 THEN '{three}' WHEN 4 THEN '{four}' "
        f"WHEN 5 THEN '{five}' ELSE 'Unknown' END"
    )


STATUS_CLASS = status_class("2xx_Success", "3xx_Redirect", "4xx_Client_Error", "5xx_Server_Error")
STATUS_CLASS_BI = status_class("2xx Success", "3xx Redirect", "4xx Client Error", "5xx Server Error")


def when(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def pct(part: str, whole: str, digits: int) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * 100 / greatest(CAST({whole} AS DOUBLE), 1)", digits)


OUTSIDE = "(temperature > 100 OR temperature < -40 OR humidity > 100 OR humidity < 0)"
RANGE_REASON = (
    "WHEN temperature > 100 THEN 'EXTREME_HIGH_TEMP' WHEN temperature < -40 THEN 'EXTREME_LOW_TEMP' "
    "WHEN humidity > 100 THEN 'INVALID_HUMIDITY_HIGH' WHEN humidity < 0 THEN 'INVALID_HUMIDITY_LOW'"
)
TEMP_BREACH = "(temperature NOT BETWEEN alert_temp_min AND alert_temp_max)"
HUMIDITY_BREACH = "(humidity NOT BETWEEN alert_humidity_min AND alert_humidity_max)"

TAG_TOTALS = f"(SELECT hashtag, {big('sum(mention_count)')} AS total_mentions FROM trending_hashtags_daily GROUP BY ALL)"
TOP_FIVE = f"(SELECT hashtag FROM {TAG_TOTALS} ORDER BY total_mentions DESC, hashtag LIMIT 5)"

SQL: dict[str, tuple[tuple[str, ...], str]] = {}

# -- processed tables ---------------------------------------------------

for _name in (WEB, SENSORS, POSTS, DAILY, TAGS):
    SQL[f"etl_{_name}"] = ((_name,), f"SELECT * FROM {_name}")

# Dates as text: engines hand them over in different types.
SQL["etl_device_metadata"] = ((DEVICES,), """
SELECT * REPLACE (CAST(install_date AS VARCHAR) AS install_date, CAST(last_maintenance AS VARCHAR) AS last_maintenance)
FROM device_metadata""")

SQL["etl_summary_variant"] = ((SENSORS,), f"""
SELECT device_id, zone, {rnd("avg(temperature)", 9)} AS avg_temp, min(temperature) AS min_temp, max(temperature) AS max_temp,
       {rnd("avg(humidity)", 9)} AS avg_humidity, count(*) AS total_readings, {when("status = 'ANOMALY'")} AS anomaly_count,
       {when("status = 'MISSING'")} AS missing_count, dt
FROM sensor_readings WHERE temperature IS NOT NULL GROUP BY ALL""")

# -- load checks --------------------------------------------------------

SQL["chk_sensor_status_counts"] = ((TYPED,), "SELECT status, count(*) AS cnt FROM typed_sendings GROUP BY status")
SQL["chk_social_user_type_counts"] = ((POSTS,), "SELECT user_type, count(*) AS post_count FROM social_posts GROUP BY user_type")
SQL["chk_device_list"] = ((DEVICES,), "SELECT device_id, device_name, zone, sla_tier, connectivity FROM device_metadata")
SQL["chk_web_by_day"] = ((WEB,), """
SELECT dt, count(*) AS row_count, count(DISTINCT client_ip) AS unique_ips FROM web_traffic GROUP BY dt ORDER BY dt LIMIT 10""")
SQL["chk_sensor_by_day_zone"] = ((SENSORS,), """
SELECT dt, zone, count(*) AS readings FROM sensor_readings GROUP BY dt, zone ORDER BY dt, zone LIMIT 20""")
SQL["chk_social_by_lang_day"] = ((POSTS,), """
SELECT language, dt, count(*) AS posts FROM social_posts GROUP BY ALL ORDER BY dt, language LIMIT 10""")
SQL["chk_device_loaded"] = ((DEVICES,), "SELECT device_id, zone, sla_tier, connectivity FROM device_metadata")
SQL["chk_top_hashtags"] = ((TAGS,), f"SELECT * FROM {TAG_TOTALS} ORDER BY total_mentions DESC, hashtag LIMIT 15")

# -- analytics ----------------------------------------------------------

SQL["q1a_anomaly_types"] = ((SENSORS,), f"""
SELECT device_id, zone, CASE WHEN temperature IS NULL OR humidity IS NULL THEN 'MISSING_READING' {RANGE_REASON} END AS anomaly_type,
       count(*) AS occurrence_count, min(timestamp_ts) AS first_occurrence, max(timestamp_ts) AS last_occurrence,
       {rnd("min(temperature)", 2)} AS min_temp_observed, {rnd("max(temperature)", 2)} AS max_temp_observed
FROM sensor_readings WHERE temperature IS NULL OR humidity IS NULL OR {OUTSIDE} GROUP BY ALL""")

SQL["q1b_anomaly_rate"] = ((SENSORS,), f"""
SELECT device_id, zone, count(*) AS total_readings, {when("status <> 'OK'")} AS anomaly_count,
       {pct(when("status <> 'OK'"), "count(*)", 2)} AS anomaly_rate_pct, {rnd("avg(data_quality_score)", 3)} AS avg_quality_score
FROM sensor_readings GROUP BY device_id, zone""")

SQL["q2a_hourly_status"] = ((WEB,), f"""
SELECT request_hour, {STATUS_CLASS} AS status_class, count(*) AS total_requests, count(DISTINCT client_ip) AS unique_visitors,
       {big("sum(response_bytes)")} AS total_bytes_served, {rnd("avg(response_bytes)", 0)} AS avg_response_size_bytes,
       min(http_status) AS min_status_code, max(http_status) AS max_status_code
FROM web_traffic GROUP BY ALL""")

SQL["q2b_top_urls"] = ((WEB,), f"""
SELECT url_path, count(*) AS total_requests, {when("http_status = 200")} AS success_count,
       {when("http_status = 404")} AS not_found_count, {when("http_status >= 500")} AS server_error_count,
       {pct(when("http_status >= 400"), "count(*)", 2)} AS error_rate_pct, {big("sum(response_bytes)")} AS total_bytes,
       {rnd("avg(response_bytes)", 0)} AS avg_response_bytes
FROM web_traffic WHERE url_path NOT IN {NOISE} GROUP BY url_path HAVING count(*) > 9
ORDER BY total_requests DESC, url_path LIMIT 20""")

SQL["q2c_heatmap"] = ((WEB,), f"""
SELECT request_hour AS hour_of_day, request_dow AS day_of_week, {DAY_NAME} AS day_name, count(*) AS request_count,
       count(DISTINCT client_ip) AS unique_ips FROM web_traffic GROUP BY ALL""")

SQL["q3a_trending"] = ((TAGS,), f"""
SELECT hashtag, {big("sum(mention_count)")} AS total_mentions, {big("sum(total_likes)")} AS total_likes,
       {big("sum(total_retweets)")} AS total_retweets, {rnd("avg(avg_engagement_rate) * 100", 4)} AS avg_engagement_pct,
       min(first_seen) AS first_seen, max(last_seen) AS last_seen,
       {rnd("sum(mention_count) + 0.1 * sum(total_likes) + 0.5 * sum(total_retweets)", 2)} AS trending_score
FROM trending_hashtags_daily GROUP BY hashtag ORDER BY trending_score DESC, hashtag LIMIT 10""")

SQL["q3b_trend_delta"] = ((TAGS,), f"""
SELECT hashtag, dt, mention_count, before AS prev_day_mentions, mention_count - before AS daily_delta,
       {rnd("CASE WHEN before = 0 THEN 100 ELSE (mention_count - before) * 100 / before END", 2)} AS growth_rate_pct
FROM (SELECT hashtag, dt, mention_count, lag(mention_count, 1, 0) OVER (PARTITION BY hashtag ORDER BY dt) AS before
      FROM trending_hashtags_daily WHERE hashtag IN {TOP_FIVE})""")

RANKED = f"""(SELECT hashtag, total_mentions,
    rank() OVER down AS mention_rank, dense_rank() OVER down AS dense_rank,
    row_number() OVER (ORDER BY total_mentions DESC, hashtag) AS row_num,
    {rnd("percent_rank() OVER down", 4)} AS percentile
  FROM {TAG_TOTALS} WINDOW down AS (ORDER BY total_mentions DESC))"""

SQL["q3c_rank_compare"] = ((TAGS,), f"SELECT * FROM {RANKED} WHERE mention_rank <= 10")


def alert(value: str, sign: str, limit: str, unit: str, code: str) -> str:
    return (f"WHEN {value} {sign} {limit} THEN '{code} (' || CAST({value} AS VARCHAR) || '{unit} {sign} ' || "
            f"CAST({limit} AS VARCHAR) || '{unit} threshold)'")


SQL["q4a_threshold_alerts"] = ((SENSORS, DEVICES), f"""
SELECT d.device_id, device_name, manufacturer, model, d.zone, d.location, floor, sla_tier, connectivity, sampling_interval_sec,
       timestamp_ts, temperature, humidity, status, data_quality_score, alert_temp_min, alert_temp_max,
       alert_humidity_min, alert_humidity_max,
       CASE {alert("temperature", "<", "alert_temp_min", "°C", "TEMP_TOO_LOW")}
            {alert("temperature", ">", "alert_temp_max", "°C", "TEMP_TOO_HIGH")}
            {alert("humidity", "<", "alert_humidity_min", "%", "HUMIDITY_TOO_LOW")}
            {alert("humidity", ">", "alert_humidity_max", "%", "HUMIDITY_TOO_HIGH")}
            ELSE 'WITHIN_THRESHOLD' END AS threshold_alert
FROM sensor_readings r JOIN device_metadata d ON r.device_id = d.device_id
WHERE status <> 'MISSING' AND dt BETWEEN '2024-01-15' AND '2024-01-20'
ORDER BY sla_tier, timestamp_ts DESC, reading_id LIMIT 1000""")

SQL["q4b_device_health"] = ((SENSORS, DEVICES), f"""
SELECT d.device_id, device_name, d.zone, sla_tier, manufacturer, count(reading_id) AS total_readings,
       {rnd("avg(temperature)", 2)} AS avg_temp, {rnd("min(temperature)", 2)} AS min_temp, {rnd("max(temperature)", 2)} AS max_temp,
       {rnd("avg(humidity)", 2)} AS avg_humidity, {rnd("avg(data_quality_score)", 3)} AS avg_quality_score,
       {when(TEMP_BREACH)} AS temp_breach_count, {when(HUMIDITY_BREACH)} AS humidity_breach_count,
       {pct(when("status = 'OK'"), "count(reading_id)", 2)} AS health_pct
FROM device_metadata d LEFT JOIN sensor_readings r ON r.device_id = d.device_id GROUP BY ALL""")

# Each grain as a query of its own, so the check does not rest on GROUPING SETS.


def grains(labels: tuple[str, str, str], figures: str) -> str:
    date_label, device_label, zone_label = (f"'{x}'" for x in labels)
    keys = [
        ("dt", "device_id", "zone"), ("dt", device_label, "zone"), ("dt", device_label, zone_label),
        (date_label, device_label, zone_label),
    ]
    return "\nUNION ALL ".join(
        f"SELECT {d} AS date_key, {v} AS device_key, {z} AS zone_key, {figures} FROM sensor_daily_summary"
        + (" GROUP BY " + ", ".join(k for k in (d, v, z) if not k.startswith("'")) if d == "dt" else "")
        for d, v, z in keys
    )


TEMPERATURES = (f"{rnd('avg(avg_temp)', 2)} AS avg_temperature, {rnd('min(min_temp)', 2)} AS min_temperature, "
                f"{rnd('max(max_temp)', 2)} AS max_temperature, {rnd('avg(avg_humidity)', 2)} AS avg_humidity, "
                f"{big('sum(total_readings)')} AS total_readings")

SQL["q5a_grouping_sets"] = ((DAILY,), grains(
    ("ALL_DATES", "ALL_DEVICES", "ALL_ZONES"),
    f"{TEMPERATURES}, {big('sum(anomaly_count)')} AS total_anomalies, "
    f"{pct('sum(anomaly_count)', 'sum(total_readings)', 3)} AS anomaly_rate_pct",
))
SQL["x4_daily_rollups"] = ((DAILY,), grains(
    ("ALL_DATES", "ALL", "ALL_ZONES"), f"{TEMPERATURES}, {big('sum(anomaly_count)')} AS anomaly_count"
))


def totals(shape: str) -> str:
    return f"""
SELECT CASE WHEN grouping(dt) = 1 THEN '=== GRAND TOTAL ===' ELSE dt END AS date_key,
       CASE WHEN grouping(zone) = 1 THEN '=== ZONE TOTAL ===' ELSE zone END AS zone_key,
       CASE WHEN grouping(device_id) = 1 THEN '=== DEVICE TOTAL ===' ELSE device_id END AS device_key,
       {big("sum(total_readings)")} AS readings, {rnd("avg(avg_temp)", 2)} AS avg_temp, {big("sum(anomaly_count)")} AS anomalies
FROM sensor_daily_summary GROUP BY {shape}(dt, zone, device_id)"""


SQL["q5b_rollup"] = ((DAILY,), totals("ROLLUP"))
SQL["agg_cube"] = ((DAILY,), totals("CUBE"))

WEEKLY = f"""min(dt) AS week_start_date, max(dt) AS week_end_date, zone, {big("sum(total_readings)")} AS weekly_readings,
       {rnd("avg(avg_temp)", 2)} AS weekly_avg_temp, {rnd("min(min_temp)", 2)} AS weekly_min_temp,
       {rnd("max(max_temp)", 2)} AS weekly_max_temp, {big("sum(anomaly_count)")} AS weekly_anomalies,
       {pct("sum(anomaly_count)", "sum(total_readings)", 3)} AS weekly_anomaly_rate_pct
FROM sensor_daily_summary GROUP BY ALL"""
WEEK = "CAST(weekofyear(CAST(dt AS DATE)) AS INTEGER) AS week_number"
SQL["q5c_weekly"] = ((DAILY,), f"SELECT {WEEK}, {WEEKLY}")
SQL["q5c_weekly_by_year"] = ((DAILY,), f"SELECT CAST(isoyear(CAST(dt AS DATE)) AS INTEGER) AS iso_year, {WEEK}, {WEEKLY}")

SQL["q_explain_web"] = ((WEB,), f"""
SELECT url_path, http_status, count(*) AS total_requests, {big("sum(response_bytes)")} AS total_bytes
FROM web_traffic WHERE dt = '2024-01-15' AND http_status = 200 GROUP BY ALL ORDER BY total_requests DESC, url_path LIMIT 10""")
SQL["q_explain_sensor"] = ((SENSORS,), f"""
SELECT device_id, {rnd("avg(temperature)", 2)} AS avg_temp, count(*) AS readings FROM sensor_readings
WHERE dt = '2024-01-15' AND zone = 'server_room' AND temperature IS NOT NULL GROUP BY device_id""")

# -- BI datasets --------------------------------------------------------

SQL["d1_web_hourly"] = ((WEB,), f"""
SELECT dt AS date, request_hour AS hour_of_day, request_dow AS day_of_week, {DAY_NAME} AS day_name,
       {STATUS_CLASS_BI} AS status_class, http_method, url_path, request_count, unique_visitors, total_bytes_mb, avg_response_kb
FROM (SELECT dt, request_hour, request_dow, http_status, http_method, url_path, count(*) AS request_count,
             count(DISTINCT client_ip) AS unique_visitors, {big("sum(response_bytes)")} AS total_bytes_mb,
             {rnd("avg(response_bytes) / 1024", 2)} AS avg_response_kb
      FROM web_traffic GROUP BY ALL)""")

SQL["d2_sensor_daily"] = ((SENSORS, DEVICES), f"""
SELECT dt AS reading_date, device_id, device_name, d.zone, d.location, floor, manufacturer, model, sla_tier,
       alert_temp_min, alert_temp_max, connectivity, latitude, longitude,
       {rnd("mean_c", 2)} AS avg_temperature_c, {rnd("low_c", 2)} AS min_temperature_c, {rnd("high_c", 2)} AS max_temperature_c,
       {rnd("mean_c * 9 / 5 + 32", 2)} AS avg_temperature_f, {rnd("mean_humidity", 2)} AS avg_humidity_pct, reading_count,
       anomaly_count, missing_count, {rnd("quality * 100", 1)} AS quality_score_pct,
       CASE WHEN high_c > alert_temp_max THEN 'HIGH_TEMP_BREACH' WHEN low_c < alert_temp_min THEN 'LOW_TEMP_BREACH'
            WHEN quality < 0.8 THEN 'LOW_QUALITY' ELSE 'NORMAL' END AS daily_status
FROM device_metadata d JOIN (
    SELECT dt, device_id, avg(temperature) AS mean_c, min(temperature) AS low_c, max(temperature) AS high_c,
           avg(humidity) AS mean_humidity, count(*) AS reading_count, {when("status = 'ANOMALY'")} AS anomaly_count,
           {when("status = 'MISSING'")} AS missing_count, avg(data_quality_score) AS quality
    FROM sensor_readings WHERE temperature IS NOT NULL GROUP BY dt, device_id) USING (device_id)""")

SQL["d3_hashtag_trends"] = ((TAGS,), f"""
SELECT dt AS trend_date, hashtag, mention_count, total_likes, total_retweets, {rnd("avg_engagement_rate * 100", 4)} AS avg_engagement_pct,
       rank() OVER (PARTITION BY dt ORDER BY mention_count DESC) AS daily_rank,
       rank() OVER (ORDER BY tag_total DESC) AS overall_rank,
       {big("sum(mention_count) OVER (PARTITION BY hashtag ORDER BY dt ROWS 6 PRECEDING)")} AS rolling_7d_mentions
FROM (SELECT *, sum(mention_count) OVER (PARTITION BY hashtag) AS tag_total FROM trending_hashtags_daily)""")

SQL["d3_user_engagement"] = ((POSTS,), f"""
SELECT user_type, dt, count(DISTINCT username) AS unique_users, count(*) AS total_posts, {big("sum(likes)")} AS total_likes,
       {big("sum(retweets)")} AS total_retweets, {big("sum(impressions)")} AS total_impressions,
       {rnd("avg(engagement_rate) * 100", 4)} AS avg_engagement_pct, {rnd("avg(followers)", 0)} AS avg_followers,
       {rnd("count(*) / count(DISTINCT username)", 2)} AS posts_per_user, {rnd("avg(hashtag_count)", 2)} AS avg_hashtags_per_post
FROM social_posts GROUP BY user_type, dt""")

KPI = f"""SELECT dt, 'web_traffic' AS data_source, count(*) AS record_count, {big("0")} AS anomaly_count,
       CAST(0 AS DOUBLE) AS anomaly_rate_pct, {big("sum(response_bytes)")} AS total_data_bytes FROM web_traffic GROUP BY dt
UNION ALL SELECT dt, 'iot_sensors', {big("sum(total_readings)")}, {big("sum(anomaly_count)")},
       {pct("sum(anomaly_count)", "sum(total_readings)", 3)}, 0 FROM sensor_daily_summary GROUP BY dt
UNION ALL SELECT dt, 'social_media', count(*), 0, 0, 0 FROM social_posts GROUP BY dt"""
SQL["d4_exec_kpi"] = ((WEB, DAILY, POSTS), KPI)
SQL["d5_hashtag_top50"] = ((TAGS,), f"SELECT hashtag, total_mentions AS mentions FROM {TAG_TOTALS} ORDER BY mentions DESC, hashtag LIMIT 50")
SQL["d5_anomaly_rows"] = ((SENSORS,), "SELECT * FROM sensor_readings WHERE status = 'ANOMALY' ORDER BY reading_id LIMIT 10000")

# -- CSV reports --------------------------------------------------------

SQL["x1_hourly_traffic"] = ((WEB,), f"""
SELECT request_hour, url_path, http_status, count(*) AS total_requests, {big("sum(response_bytes)")} AS total_bytes,
       count(DISTINCT client_ip) AS unique_visitors, {rnd("avg(response_bytes)", 2)} AS avg_response_bytes
FROM web_traffic GROUP BY ALL""")
SQL["x2_trending_top20"] = ((TAGS,), """
SELECT hashtag, mention_count, total_likes, total_retweets, avg_engagement_rate, first_seen, last_seen
FROM trending_hashtags_daily ORDER BY mention_count DESC, hashtag, dt LIMIT 20""")
SQL["x3_sensor_anomalies"] = ((SENSORS, DEVICES), f"""
SELECT reading_id, d.device_id, device_name, d.zone, d.location, timestamp_ts AS timestamp, temperature, humidity, status,
       CASE {RANGE_REASON} ELSE 'ANOMALY' END AS anomaly_type
FROM sensor_readings r JOIN device_metadata d ON r.device_id = d.device_id WHERE status = 'ANOMALY' OR {OUTSIDE}""")
SQL["x5_sensor_device"] = ((SENSORS, DEVICES), f"""
SELECT d.device_id, device_name, manufacturer, model, d.zone, d.location, sla_tier, alert_temp_min, alert_temp_max, connectivity,
       count(reading_id) AS total_readings, {rnd("avg(temperature)", 2)} AS avg_temp, {rnd("min(temperature)", 2)} AS min_temp,
       {rnd("max(temperature)", 2)} AS max_temp, {rnd("avg(humidity)", 2)} AS avg_humidity,
       {when("status = 'ANOMALY'")} AS anomaly_count, {when("status = 'MISSING'")} AS missing_count
FROM device_metadata d LEFT JOIN sensor_readings r ON r.device_id = d.device_id GROUP BY ALL""")

# -- dashboards ---------------------------------------------------------

SQL["p_status_distribution"] = ((WEB,), f"""
SELECT request_hour, {STATUS_CLASS} AS status_class, count(*) AS requests,
       {rnd("count(*) * 100.0 / (SELECT count(*) FROM web_traffic)", 4)} AS share_pct FROM web_traffic GROUP BY ALL""")
SQL["p_top_pages"] = ((WEB,), f"""
SELECT url_path, count(*) AS page_views FROM web_traffic WHERE url_path NOT IN {NOISE} GROUP BY url_path
ORDER BY page_views DESC, url_path LIMIT 15""")
SQL["p_temp_by_device_time"] = ((SENSORS,), f"""
SELECT device_id, date_trunc('hour', timestamp_ts) AS hour_start, {rnd("avg(temperature)", 2)} AS avg_temp,
       {rnd("avg(humidity)", 2)} AS avg_humidity, count(*) AS readings FROM sensor_readings GROUP BY ALL""")
SQL["p_current_status"] = ((SENSORS,), """
SELECT device_id, reading_id, zone, timestamp_ts, temperature, humidity, status, data_quality_score FROM sensor_readings
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY timestamp_ts DESC, reading_id DESC) = 1""")
SQL["p_temp_humidity_scatter"] = ((SENSORS,), """
SELECT device_id, timestamp_ts, temperature, humidity, status = 'ANOMALY' AS is_anomaly FROM sensor_readings
WHERE temperature IS NOT NULL AND humidity IS NOT NULL""")
SQL["p_device_scorecard"] = ((SENSORS, DEVICES), f"""
SELECT device_id, device_name, sla_tier, ok AS ok_readings, expected AS expected_readings,
       {rnd("ok * 100.0 / greatest(expected, 1)", 2)} AS uptime_pct, mean_temp AS avg_temp, alerts AS alert_count
FROM (SELECT d.device_id, device_name, sla_tier, {when("status = 'OK'")} AS ok, {rnd("avg(temperature)", 2)} AS mean_temp,
             {big(f"{when(TEMP_BREACH)} + {when(HUMIDITY_BREACH)}")} AS alerts,
             CASE WHEN count(reading_id) = 0 THEN 0
                  ELSE {big("date_diff('second', min(timestamp_ts), max(timestamp_ts)) // sampling_interval_sec + 1")} END AS expected
      FROM device_metadata d LEFT JOIN sensor_readings r ON r.device_id = d.device_id
      GROUP BY d.device_id, device_name, sla_tier, sampling_interval_sec)""")
SQL["p_location_heat"] = ((SENSORS, DEVICES), f"""
SELECT location, zone, {rnd("avg(latitude)", 4)} AS latitude, {rnd("avg(longitude)", 4)} AS longitude, count(*) AS devices,
       {big("coalesce(sum(n), 0)")} AS readings, {rnd("sum(temp_sum) / sum(temp_n)", 2)} AS avg_temp
FROM device_metadata LEFT JOIN (
    SELECT device_id, count(*) AS n, sum(CAST(temperature AS DECIMAL(18,2))) AS temp_sum, count(temperature) AS temp_n
    FROM sensor_readings GROUP BY device_id) USING (device_id) GROUP BY location, zone""")
SQL["p_engagement_timeline"] = ((POSTS,), f"""
SELECT dt, likes, retweets, {big("sum(likes) OVER (ORDER BY dt)")} AS cumulative_likes,
       {big("sum(retweets) OVER (ORDER BY dt)")} AS cumulative_retweets
FROM (SELECT dt, {big("sum(likes)")} AS likes, {big("sum(retweets)")} AS retweets FROM social_posts GROUP BY dt)""")
SQL["p_word_frequency"] = ((), """
SELECT word, count(*) AS frequency
FROM (SELECT unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents) WHERE word <> ''
GROUP BY word ORDER BY frequency DESC, word LIMIT 100""")
SQL["p_influencers"] = ((POSTS,), f"""
SELECT username, max(followers) AS followers, count(*) AS posts, {rnd("avg(engagement_rate) * 100", 4)} AS avg_engagement_pct,
       {big("max(followers) * count(*)")} AS reach FROM social_posts GROUP BY username""")
SQL["p_posts_by_type_day"] = ((POSTS,), "SELECT dt, user_type, count(*) AS posts FROM social_posts GROUP BY ALL")
SQL["p_kpi_cards"] = ((DAILY, TAGS, WEB), f"""
SELECT {big("sum(total_readings)")} AS total_readings, {pct("sum(anomaly_count)", "sum(total_readings)", 3)} AS anomaly_rate_pct,
       (SELECT hashtag FROM {TAG_TOTALS} ORDER BY total_mentions DESC, hashtag LIMIT 1) AS top_hashtag,
       (SELECT request_hour FROM web_traffic GROUP BY request_hour ORDER BY count(*) DESC, request_hour LIMIT 1) AS peak_hour
FROM sensor_daily_summary""")
SQL["p_requests_vs_anomalies"] = ((WEB, DAILY), f"""
SELECT dt, {big("sum(w)")} AS web_requests, {big("sum(a)")} AS sensor_anomalies
FROM (SELECT dt, 1 AS w, 0 AS a FROM web_traffic UNION ALL SELECT dt, 0, anomaly_count FROM sensor_daily_summary) GROUP BY dt""")
SQL["p_sla_compliance"] = ((SENSORS, DEVICES), f"""
SELECT *, health_pct >= target_pct AS compliant
FROM (SELECT d.device_id, device_name, sla_tier, count(reading_id) AS total_readings,
             {pct(when("status = 'OK'"), "count(reading_id)", 2)} AS health_pct,
             CAST(CASE sla_tier WHEN 'GOLD' THEN 99.9 WHEN 'SILVER' THEN 99.5 WHEN 'BRONZE' THEN 99 END AS DOUBLE) AS target_pct
      FROM device_metadata d LEFT JOIN sensor_readings r ON r.device_id = d.device_id GROUP BY ALL)""")
SQL["p_volume_by_source"] = ((WEB, DAILY, POSTS), f"""
SELECT data_source, {big("sum(record_count)")} AS record_count, {big("sum(total_data_bytes)")} AS total_data_bytes
FROM ({KPI}) GROUP BY data_source""")
SQL["p_ip_region"] = ((WEB,), """
SELECT CASE split_part(client_ip, '.', 1) WHEN '192' THEN 'block_192_168' WHEN '10' THEN 'block_10' ELSE 'block_172_16' END AS region,
       count(*) AS requests, count(DISTINCT client_ip) AS unique_ips FROM web_traffic GROUP BY ALL""")

# -- profiles -----------------------------------------------------------


def profile(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value, "
            f"count(*) - count({column}) AS null_count, {rnd(f'avg(length(CAST({column} AS VARCHAR)))', 4)} AS avg_length FROM sensor_readings")


SQL["column_profile"] = ((SENSORS,), "\nUNION ALL ".join(
    profile(c) for c in ("device_id", "temperature", "humidity", "status", "data_quality_score")
))

SQL["column_cardinality"] = ((SENSORS,), "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, TRUE AS estimate_is_near FROM sensor_readings"
    for c in ("device_id", "temperature", "humidity", "status", "data_quality_score")
))

# -- projections and filters --------------------------------------------

SQL["p_select_alias"] = ((WEB,), "SELECT client_ip AS visitor, url_path AS page, http_status FROM web_traffic")
SQL["p_literal_cols"] = ((POSTS,), "SELECT dt, 'social_media' AS data_source, tweet_id FROM social_posts")
SQL["p_backtick_ident"] = ((DEVICES,), "SELECT floor, count(*) AS devices FROM device_metadata GROUP BY floor")
SQL["f_not_null"] = ((SENSORS,), """
SELECT reading_id, temperature, humidity FROM sensor_readings WHERE temperature IS NOT NULL AND humidity IS NOT NULL""")
SQL["f_is_null_or_range"] = ((SENSORS,), f"""
SELECT reading_id, temperature, humidity FROM sensor_readings WHERE temperature IS NULL OR humidity IS NULL OR {OUTSIDE}""")
SQL["f_eq_neq"] = ((SENSORS,), """
SELECT reading_id, status, zone FROM sensor_readings WHERE status != 'MISSING' AND zone = 'server_room'""")
SQL["f_in_list"] = ((SENSORS,), "SELECT reading_id, status FROM sensor_readings WHERE status IN ('ANOMALY', 'MISSING')")
SQL["f_not_in_list"] = ((WEB,), f"""
SELECT url_path, count(*) AS requests FROM web_traffic WHERE url_path NOT IN {NOISE} GROUP BY url_path""")
SQL["f_in_subquery"] = ((TAGS,), f"SELECT hashtag, dt, mention_count FROM trending_hashtags_daily WHERE hashtag IN {TOP_FIVE}")
SQL["f_between"] = ((WEB,), """
SELECT http_status, count(*) AS requests FROM web_traffic WHERE http_status BETWEEN 400 AND 499 GROUP BY http_status""")
SQL["f_rlike"] = ((POSTS,), """
SELECT starts_with(token, '#') AS is_tag, count(*) AS tokens
FROM (SELECT unnest(string_split_regex(trim(hashtags), '[ ]+')) AS token FROM social_posts) GROUP BY is_tag""")
SQL["f_partition_range"] = ((SENSORS,), """
SELECT dt, count(*) AS readings FROM sensor_readings WHERE dt >= '2024-01-15' AND dt <= '2024-01-20' GROUP BY dt""")
SQL["f_having"] = ((WEB,), "SELECT url_path, count(*) AS requests FROM web_traffic GROUP BY url_path HAVING count(*) >= 10")
DAY_RANK = """SELECT dt, hashtag, mention_count,
       rank() OVER (PARTITION BY dt ORDER BY mention_count DESC) AS daily_rank FROM trending_hashtags_daily"""
SQL["f_rank_filter"] = ((TAGS,), f"SELECT * FROM ({DAY_RANK}) WHERE daily_rank = 1")
SQL["case_searched"] = ((SENSORS,), """
SELECT CASE WHEN data_quality_score >= 1 THEN 'good' WHEN data_quality_score > 0 THEN 'usable' ELSE 'invalid' END AS quality,
       count(*) AS readings FROM sensor_readings GROUP BY quality""")
SQL["case_simple"] = ((WEB,), f"SELECT {DAY_NAME} AS day_name, count(*) AS requests FROM web_traffic GROUP BY ALL")
SQL["derived_table"] = ((TAGS,), """
SELECT * FROM (SELECT hashtag, count(*) AS days, max(mention_count) AS most_mentions FROM trending_hashtags_daily GROUP BY hashtag)
WHERE days > 1""")
SQL["cte"] = ((DAILY,), f"""
SELECT dt, anomalies, lag(anomalies) OVER (ORDER BY dt) AS day_before
FROM (SELECT dt, {big("sum(anomaly_count)")} AS anomalies FROM sensor_daily_summary GROUP BY dt)""")

# -- joins --------------------------------------------------------------

JOINED = "sensor_readings r JOIN device_metadata d ON r.device_id = d.device_id"
SQL["join_inner_equi"] = ((SENSORS, DEVICES), f"SELECT d.device_id, reading_id, temperature, device_name, sla_tier FROM {JOINED}")
SQL["join_left_outer"] = ((SENSORS, DEVICES), """
SELECT d.device_id, d.zone, count(reading_id) AS total_readings
FROM device_metadata d LEFT JOIN sensor_readings r ON r.device_id = d.device_id GROUP BY ALL""")
SQL["join_map_broadcast"] = ((SENSORS, DEVICES), f"SELECT sla_tier, count(*) AS readings FROM {JOINED} GROUP BY sla_tier")
SQL["join_common_shuffle"] = ((SENSORS, DEVICES), f"SELECT manufacturer, count(*) AS readings FROM {JOINED} GROUP BY manufacturer")
SQL["join_skew"] = ((SENSORS, DEVICES), f"""
SELECT sla_tier, count(*) AS readings, {rnd("avg(temperature)", 2)} AS avg_temp FROM {JOINED} GROUP BY sla_tier""")
SQL["join_inequality_post"] = ((SENSORS, DEVICES), f"""
SELECT sla_tier, {when(TEMP_BREACH)} AS temp_breaches, {when(HUMIDITY_BREACH)} AS humidity_breaches FROM {JOINED} GROUP BY sla_tier""")
SQL["topk_in_subquery"] = ((TAGS,), f"""
SELECT hashtag, count(*) AS days, {big("sum(total_likes)")} AS likes FROM trending_hashtags_daily
WHERE hashtag IN {TOP_FIVE} GROUP BY hashtag""")
SQL["join_semi_topk"] = ((SENSORS, DEVICES), """
SELECT device_id, count(*) AS readings, max(timestamp_ts) AS last_ts FROM sensor_readings
WHERE device_id IN (SELECT device_id FROM device_metadata WHERE battery_level_pct IS NOT NULL ORDER BY battery_level_pct, device_id LIMIT 5)
GROUP BY device_id""")

# -- aggregates ---------------------------------------------------------

SQL["agg_hash_groupby"] = ((WEB,), "SELECT http_method, http_status, count(*) AS requests FROM web_traffic GROUP BY ALL")
SQL["agg_groupby_expr"] = ((DAILY,), f"SELECT {WEEK}, {big('sum(total_readings)')} AS readings FROM sensor_daily_summary GROUP BY ALL")
SQL["agg_count_star_col"] = ((SENSORS,), """
SELECT zone, count(*) AS all_rows, count(temperature) AS with_temperature FROM sensor_readings GROUP BY zone""")
SQL["agg_count_distinct"] = ((WEB,), "SELECT dt, count(DISTINCT client_ip) AS unique_ips FROM web_traffic GROUP BY dt")
SQL["agg_count_distinct_estimate"] = ((WEB,), """
SELECT dt, count(DISTINCT client_ip) AS unique_ips, TRUE AS estimate_is_near FROM web_traffic GROUP BY dt""")
SQL["agg_sum_avg_min_max"] = ((WEB,), f"""
SELECT http_method, {big("sum(response_bytes)")} AS sum_bytes, {rnd("avg(response_bytes)", 4)} AS avg_bytes,
       min(request_ts) AS first_ts, max(request_ts) AS last_ts, min(dt) AS first_dt, max(dt) AS last_dt
FROM web_traffic GROUP BY http_method""")
SQL["agg_conditional_sum"] = ((WEB,), f"""
SELECT dt, {when("http_status = 200")} AS ok, {when("http_status >= 500")} AS failed FROM web_traffic GROUP BY dt""")
SQL["agg_ratio_pct"] = ((WEB,), f"""
SELECT http_method, {pct(when("http_status >= 400"), "count(*)", 2)} AS error_rate_pct FROM web_traffic GROUP BY http_method""")
SQL["agg_safe_ratio"] = ((POSTS,), f"""
SELECT username, {rnd("CAST(sum(likes + retweets) AS DOUBLE) / greatest(sum(impressions), 1)", 6)} AS rate
FROM social_posts GROUP BY username""")
SQL["agg_of_agg"] = ((DAILY,), f"""
SELECT zone, {big("sum(total_readings)")} AS readings, {rnd("avg(avg_temp)", 2)} AS mean_of_means, min(min_temp) AS lowest,
       max(max_temp) AS highest FROM sensor_daily_summary GROUP BY zone""")
SQL["agg_case_over_agg"] = ((SENSORS,), """
SELECT device_id, CASE WHEN max(temperature) > 100 THEN 'hot' WHEN avg(data_quality_score) < 0.8 THEN 'poor' ELSE 'fine' END AS state
FROM sensor_readings GROUP BY device_id""")
SQL["agg_skew_two_pass"] = ((WEB,), """
SELECT http_status, count(*) AS requests, count(DISTINCT client_ip) AS unique_ips FROM web_traffic GROUP BY http_status""")

# -- windows ------------------------------------------------------------

SQL["w_row_number_dedup"] = ((TYPED,), """
SELECT device_id, ts, min(reading_id) AS reading_id FROM typed_sendings GROUP BY device_id, ts""")
SQL["w_lag"] = ((TAGS,), """
SELECT hashtag, dt, mention_count, lag(mention_count) OVER (PARTITION BY hashtag ORDER BY dt) AS prev_mentions
FROM trending_hashtags_daily""")
SQL["w_rank_global"] = ((TAGS,), f"SELECT hashtag, total_mentions, mention_rank FROM {RANKED}")
SQL["w_dense_rank"] = ((TAGS,), f"SELECT hashtag, total_mentions, dense_rank AS mention_dense_rank FROM {RANKED}")
SQL["w_row_number_global"] = ((TAGS,), f"SELECT hashtag, total_mentions, row_num FROM {RANKED}")
SQL["w_percent_rank"] = ((TAGS,), f"SELECT hashtag, total_mentions, percentile FROM {RANKED}")
SQL["w_rank_partitioned"] = ((TAGS,), DAY_RANK)
SQL["w_sum_partition"] = ((TAGS,), f"""
SELECT dt, hashtag, {big("sum(mention_count) OVER (PARTITION BY hashtag)")} AS hashtag_total FROM trending_hashtags_daily""")
SQL["w_nested"] = ((TAGS,), f"""
SELECT *, rank() OVER (ORDER BY hashtag_total DESC) AS overall_rank
FROM (SELECT dt, hashtag, {big("sum(mention_count) OVER (PARTITION BY hashtag)")} AS hashtag_total FROM trending_hashtags_daily)""")
SQL["w_rolling_rows"] = ((TAGS,), f"""
SELECT dt, hashtag, {big("sum(mention_count) OVER (PARTITION BY hashtag ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")}
       AS rolling_7_rows FROM trending_hashtags_daily""")
SQL["w_rolling_days"] = ((TAGS,), f"""
SELECT a.dt, a.hashtag, {big("sum(b.mention_count)")} AS rolling_7_days
FROM trending_hashtags_daily a JOIN trending_hashtags_daily b ON a.hashtag = b.hashtag
     AND date_diff('day', CAST(b.dt AS DATE), CAST(a.dt AS DATE)) BETWEEN 0 AND 6 GROUP BY a.dt, a.hashtag""")
SQL["w_cumulative"] = ((TAGS,), f"""
SELECT dt, hashtag, {big("sum(mention_count) OVER (PARTITION BY hashtag ORDER BY dt ROWS UNBOUNDED PRECEDING)")} AS mentions_so_far
FROM trending_hashtags_daily""")

# -- sorts and limits ---------------------------------------------------

SQL["sort_multi"] = ((DEVICES,), "SELECT device_id, zone, sla_tier FROM device_metadata")
SQL["sort_nulls_last"] = ((DEVICES,), """
SELECT device_id, battery_level_pct, row_number() OVER (ORDER BY battery_level_pct NULLS LAST, device_id) AS place FROM device_metadata""")
SQL["sort_default_nulls"] = ((DEVICES,), """
SELECT device_id, battery_level_pct, row_number() OVER (ORDER BY battery_level_pct NULLS FIRST, device_id) AS place FROM device_metadata""")
SQL["limit_sample"] = ((WEB,), "SELECT least(count(*), 5) AS sampled, least(count(*), 5) AS found FROM web_traffic")
SQL["chk_weblog_sample"] = ((LOGS,), "SELECT least(count(*), 5) AS sampled, least(count(*), 5) AS found FROM logs")
SQL["bucket_sample"] = ((WEB,), """
SELECT client_ip, count(*) AS requests FROM web_traffic WHERE CAST('0x' || substr(md5(client_ip), 1, 8) AS BIGINT) % 32 = 0 GROUP BY client_ip""")
SQL["topk"] = ((WEB,), f"""
SELECT client_ip, {big("sum(response_bytes)")} AS total_bytes FROM web_traffic GROUP BY client_ip
ORDER BY total_bytes DESC, client_ip LIMIT 15""")

# -- sets and scalars ---------------------------------------------------

SQL["union_all_3"] = ((WEB, SENSORS, POSTS), """
SELECT dt, data_source, count(*) AS records
FROM (SELECT dt, 'web_traffic' AS data_source FROM web_traffic UNION ALL SELECT dt, 'iot_sensors' FROM sensor_readings
      UNION ALL SELECT dt, 'social_media' FROM social_posts) GROUP BY ALL""")
SQL["fn_request_parts"] = ((WEB,), """
SELECT http_method, url_path, url_query, http_protocol, count(*) AS requests FROM web_traffic GROUP BY ALL""")
SQL["fn_size_split"] = ((POSTS,), "SELECT hashtag_count, count(*) AS posts FROM social_posts GROUP BY hashtag_count")
SQL["fn_explode"] = ((POSTS, "mentions"), "SELECT tweet_id, hashtag FROM mentions")
SQL["fn_arithmetic"] = ((SENSORS,), f"SELECT reading_id, {rnd('temperature * 9 / 5 + 32', 2)} AS temperature_f FROM sensor_readings")


# -- raw sources --------------------------------------------------------


def unbroken(expression: str) -> str:
    return f"CASE WHEN NOT broken THEN {expression} END"


SQL["scan_clf"] = ((LOGS,), f"""
SELECT {unbroken("client_ip")} AS client_ip, CAST(NULL AS VARCHAR) AS rfc_ident, CAST(NULL AS VARCHAR) AS auth_user,
       {unbroken("strftime(request_ts, '%d/%b/%Y:%H:%M:%S') || ' +0000'")} AS raw_timestamp,
       {unbroken('''http_method || ' ' || url_path || CASE WHEN url_query <> '' THEN '?' || url_query ELSE '' END
                    || CASE WHEN second_mark THEN '?x' ELSE '' END || ' HTTP/1.1' ''')} AS http_request,
       {unbroken("http_status")} AS http_status,
       {unbroken("CASE WHEN no_body THEN '-' ELSE CAST(cents AS VARCHAR) END")} AS response_bytes,
       {unbroken("referrer")} AS referrer, {unbroken("user_agent")} AS user_agent
FROM logs""")
SQL["null_token"] = ((LOGS,), """
SELECT count(*) AS lines, count(*) AS null_ident, count(*) AS null_user,
       count(*) FILTER (NOT broken AND referrer = '-') AS direct, count(*) FILTER (NOT broken AND no_body) AS no_body
FROM logs""")
SQL["fn_log_time"] = ((WEB,), "SELECT request_ts, request_hour, request_dow, dt FROM web_traffic")
SQL["raw_string_typing"] = ((TYPED,), """
SELECT reading_id, device_id, location, zone, ts, temperature, humidity, status, is_duplicate FROM typed_sendings""")
SQL["p_select_star_subq"] = ((SENSORS,), """
SELECT s.reading_id, s.device_id, s.location, s.zone, s.ts, s.temperature, s.humidity, s.status, s.is_duplicate, data_quality_score
FROM typed_sendings s JOIN sensor_readings r ON r.reading_id = s.reading_id""")

# -- files written and read back ----------------------------------------

SQL["scan_clf_files"] = SQL["scan_clf"]
SQL["scan_sensor_csv"] = SQL["raw_string_typing"]
SQL["scan_social_csv"] = ((POSTS,), r"""
SELECT tweet_id, username, user_type, followers, verified, strftime(post_ts, '%Y-%m-%d %H:%M:%S') AS ts, post_text, hashtags, likes, retweets, replies, impressions, language, source
FROM social_posts""")
SQL["scan_social_csv_blocks"] = SQL["scan_social_csv"]
SQL["scan_device_csv"] = SQL["etl_device_metadata"]
SQL["dynpart_overwrite"] = ((WEB,), """
SELECT client_ip, http_status, response_bytes, request_ts, dt FROM web_traffic WHERE dt <> '2024-01-15' OR http_status < 400""")
SQL["csv_tsv_formats"] = SQL["x1_hourly_traffic"]
for _name in ("web_traffic", "sensor_readings", "social_posts", "device_metadata", "sensor_daily_summary", "trending_hashtags_daily"):
    SQL[f"write_{_name}"] = SQL[f"etl_{_name}"]
    SQL[f"load_new_{_name}"] = SQL[f"etl_{_name}"]
    if _name != "device_metadata":
        SQL[f"stream_{_name}"] = SQL[f"etl_{_name}"]
SQL["full_overwrite"] = SQL["etl_device_metadata"]
SQL["multi_insert"] = ((SENSORS, DAILY), """
SELECT dt, readings, coalesce(summaries, 0) AS summaries FROM (SELECT dt, count(*) AS readings FROM sensor_readings GROUP BY dt)
LEFT JOIN (SELECT dt, count(*) AS summaries FROM sensor_daily_summary GROUP BY dt) USING (dt)""")
SQL["delimited_dir_sink"] = SQL["x1_hourly_traffic"]
SQL["archive_snapshot"] = SQL["scan_clf"]
SQL["archive_incremental"] = (SQL["scan_clf"][0], f"SELECT *, TRUE AS only_new_copied FROM ({SQL['scan_clf'][1]})")
SQL["compact_partition"] = SQL["etl_sensor_readings"]
SQL["compact_table"] = (
    SQL["etl_sensor_readings"][0], f"SELECT *, TRUE AS large_files_kept, TRUE AS files_as_planned FROM ({SQL['etl_sensor_readings'][1]})")
SQL["multi_insert_one_pass"] = ((SENSORS,), " UNION ALL ".join(
    f"SELECT '{_target}' AS target, dt, zone, count(*) AS n, count(DISTINCT device_id) AS devices FROM sensor_readings WHERE {_rows} GROUP BY dt, zone"
    for _target, _rows in (("readings", "TRUE"), ("anomalies", "status = 'ANOMALY'"), ("missing", "status = 'MISSING'"))))
SQL["retention_prune"] = ((WEB,), "SELECT * FROM web_traffic WHERE dt >= '2024-01-10'")
SQL["join_smb_bucket"] = SQL["join_map_broadcast"]
SQL["bucket_sample_files"] = ((WEB,), "SELECT client_ip, count(*) AS requests FROM web_traffic GROUP BY client_ip")
SQL["w_rank_double"] = ((SENSORS,), f"""
SELECT reading_id, temperature, rank() OVER w AS rank, dense_rank() OVER w AS dense, {rnd("percent_rank() OVER w", 6)} AS pr
FROM sensor_readings WINDOW w AS (ORDER BY temperature DESC NULLS LAST)""")
SQL["agg_count_distinct_grains"] = ((WEB,), """
SELECT coalesce(dt, 'ALL') AS dt, coalesce(request_hour, -1) AS request_hour, count(DISTINCT client_ip) AS unique_visitors
FROM web_traffic GROUP BY GROUPING SETS ((dt, request_hour), (dt), ())""")


def _statistics(column: str, number: bool) -> str:
    low, high = (f"CAST({f}({column}) AS {'DOUBLE' if number else 'VARCHAR'})" for f in ("min", "max"))
    numbers, texts = (f"{low} AS min_{{0}}, {high} AS max_{{0}}", "CAST(NULL AS {1}) AS min_{0}, CAST(NULL AS {1}) AS max_{0}")[::1 if number else -1]
    return (f"SELECT '{column}' AS column_name, count(*) AS row_count, count(*) FILTER ({column} IS NULL) AS null_count, {numbers.format('number', 'DOUBLE')}, "
            f"{texts.format('text', 'VARCHAR')}, count(DISTINCT {column}) AS distinct_values, TRUE AS estimate_is_near FROM sensor_readings")


SQL["column_statistics_daily"] = ((SENSORS,), " UNION ALL ".join(
    _statistics(c, c not in ("device_id", "status")) for c in ("device_id", "temperature", "humidity", "status", "data_quality_score")))


def all_sql() -> dict[str, str]:
    return {name: with_views(sql, *views) if views else sql for name, (views, sql) in SQL.items()}
