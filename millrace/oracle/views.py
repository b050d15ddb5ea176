"""The processed tables in DuckDB SQL, computed straight from the test tables.

Nothing here parses log lines or CSV text, so agreement with the Spark side
also vouches for its parsing.
"""

from __future__ import annotations


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding as DOUBLE arithmetic: a relative nudge of 1e-12 stands in for noise at a tie."""
    value, scale = f"CAST({expression} AS DOUBLE)", f"1e{digits}"
    return f"(sign({value}) * floor(abs({value}) * {scale} * (1 + 1e-12) + 0.5) / {scale})"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def pick(values: str, index: str) -> str:
    """The entry of a blank-separated list at a 0-based index."""
    items = ", ".join(f"'{v}'" for v in values.split())
    return f"([{items}])[({index}) + 1]"


def padded(prefix: str, number: str) -> str:
    return f"'{prefix}' || CASE WHEN {number} < 100000 THEN lpad(CAST({number} AS VARCHAR), 5, '0') ELSE CAST({number} AS VARCHAR) END"


def zone(number: str) -> str:
    """Six zones, the first of which a query asks for by name."""
    return f"CASE WHEN {number} % 6 = 0 THEN 'server_room' ELSE 'zone-' || ({number}) % 6 END"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}

VIEWS["logs"] = ((), f"""
SELECT event_id, event_id % 499 = 0 AS broken,
       {pick("192.168. 10.0. 172.16.", "user_id % 3")} || (user_id % 256) || '.' || (user_id // 256 + 1) AS client_ip,
       date_trunc('second', ts) AS request_ts,
       CASE WHEN event_id % 10 < 7 THEN 'GET' WHEN event_id % 10 < 9 THEN 'POST' ELSE 'PUT' END AS http_method,
       CASE WHEN event_id % 41 = 0 THEN '/favicon.ico'
            WHEN event_id % 3 = 0 OR event_id % 7 = 0 THEN '/' || event_type
            ELSE '/' || event_type || '/' || (user_id % 5) END AS url_path,
       CASE WHEN event_id % 41 = 0 OR event_id % 3 = 0 THEN ''
            ELSE 'k=' || regexp_extract(props, '"k": *([0-9]+)', 1) END AS url_query,
       event_id % 41 <> 0 AND event_id % 3 <> 0 AND event_id % 7 = 0 AS second_mark,
       CAST(CASE WHEN event_id % 20 < 12 THEN 200 WHEN event_id % 20 < 14 THEN 304 WHEN event_id % 20 < 15 THEN 301
                 WHEN event_id % 20 < 17 THEN 404 WHEN event_id % 20 < 18 THEN 403 WHEN event_id % 20 < 19 THEN 500
                 ELSE 503 END AS INTEGER) AS http_status,
       event_id % 97 = 0 AS no_body,
       {big("floor(CAST(value AS DECIMAL(18,2)) * 100)")} AS cents,
       CASE WHEN event_id % 4 = 0 THEN 'https://www.example.com/' ELSE '-' END AS referrer,
       'ua/' || (user_id % 10) AS user_agent
FROM events""")

VIEWS["web_traffic"] = (("logs",), """
SELECT client_ip, http_method, url_path, url_query, 'HTTP/1.1' AS http_protocol, http_status,
       CASE WHEN no_body THEN 0 ELSE cents END AS response_bytes, referrer, user_agent,
       CAST(hour(request_ts) AS INTEGER) AS request_hour, CAST(dayofweek(request_ts) + 1 AS INTEGER) AS request_dow,
       request_ts, strftime(request_ts, '%Y-%m-%d') AS dt
FROM logs WHERE NOT broken""")

VIEWS["sendings"] = ((), f"""
SELECT e.event_id + copy * 1000000000 AS reading_id, {padded("SENSOR-", "user_id")} AS device_id,
       'site-' || (user_id % 8) AS location, {zone("user_id")} AS zone,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, date_trunc('second', ts) AS timestamp_ts,
       event_id % 200 = 0 AS blank,
       CAST(CAST(value AS DECIMAL(18,2)) * 0.6 - 41.5 AS DECIMAL(18,2)) AS t,
       CAST((event_id * 7919 % 1300) * 0.1 - 15 AS DECIMAL(18,1)) AS h,
       event_id % 500 = 0 AS is_duplicate
FROM events e, (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR event_id % 50 = 0""")

VIEWS["typed_sendings"] = (("sendings",), """
SELECT reading_id, device_id, location, zone, ts, timestamp_ts,
       CASE WHEN NOT blank THEN CAST(t AS DOUBLE) END AS temperature,
       CASE WHEN NOT blank THEN CAST(h AS DOUBLE) END AS humidity,
       CASE WHEN blank THEN 'MISSING' WHEN t NOT BETWEEN -40 AND 100 OR h NOT BETWEEN 0 AND 100 THEN 'ANOMALY'
            ELSE 'OK' END AS status,
       is_duplicate
FROM sendings""")

VIEWS["sensor_readings"] = (("sendings", "typed_sendings"), """
SELECT reading_id, device_id, location, timestamp_ts, temperature, humidity, status, is_duplicate,
       CAST(CASE WHEN status <> 'OK' THEN 0 WHEN is_duplicate THEN 0.5
                 WHEN temperature NOT BETWEEN -30 AND 85 THEN 0.25 ELSE 1 END AS DOUBLE) AS data_quality_score,
       strftime(timestamp_ts, '%Y-%m-%d') AS dt, zone
FROM typed_sendings
QUALIFY row_number() OVER (PARTITION BY device_id, ts ORDER BY reading_id) = 1""")

VIEWS["device_metadata"] = ((), f"""
SELECT {padded("SENSOR-", "(s_suppkey * 2)")} AS device_id, s_name AS device_name, 'M' || (s_suppkey % 7) AS model,
       'v' || (s_suppkey % 3) || '.' || (s_suppkey % 10) AS firmware_version, n_name AS manufacturer,
       'site-' || (s_suppkey * 2 % 8) AS location, 'level-' || (s_suppkey % 4) AS floor,
       {zone("s_suppkey * 2")} AS zone,
       CAST(s_suppkey % 90 AS DOUBLE) AS latitude, CAST(s_suppkey % 180 AS DOUBLE) AS longitude,
       DATE '2022-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS install_date,
       DATE '2022-01-01' + CAST(s_suppkey % 365 + 400 AS INTEGER) AS last_maintenance,
       CAST(CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey * 37 % 101 END AS INTEGER) AS battery_level_pct,
       'link-' || (s_suppkey % 5) AS connectivity,
       CAST(3600 * (s_suppkey % 4 + 1) AS INTEGER) AS sampling_interval_sec,
       CAST(s_suppkey % 5 - 20 AS DOUBLE) AS alert_temp_min, CAST(s_suppkey % 5 + 20 AS DOUBLE) AS alert_temp_max,
       CAST(s_suppkey % 5 + 20 AS DOUBLE) AS alert_humidity_min, CAST(s_suppkey % 5 + 80 AS DOUBLE) AS alert_humidity_max,
       s_suppkey % 9 <> 0 AS active, 'CC-' || (s_suppkey % 6) AS cost_center, {pick("GOLD SILVER BRONZE", "s_suppkey % 3")} AS sla_tier
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")

VIEWS["social_posts"] = ((), f"""
SELECT tweet_id, username, user_type, followers, verified, post_ts, post_text, hashtags,
       CAST(CASE WHEN hashtags = '' THEN 1 WHEN hashtags LIKE '% plain' THEN 4 ELSE 3 END AS INTEGER) AS hashtag_count,
       likes, retweets, replies, impressions,
       {rnd("CAST(likes + retweets + replies AS DOUBLE) / greatest(impressions, 1)", 6)} AS engagement_rate,
       source, strftime(post_ts, '%Y-%m-%d') AS dt, language
FROM (SELECT doc_id AS tweet_id, {padded("user_", "(doc_id % 97)")} AS username,
             'group-' || (doc_id % 5) AS user_type, doc_id * 7919 % 100000 AS followers,
             doc_id % 10 = 0 AS verified,
             TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) + to_seconds(doc_id * 37 % 86400) AS post_ts,
             text AS post_text,
             CASE WHEN doc_id % 25 = 0 THEN ''
                  ELSE '#' || lang || ' #' || source || '  #top' || (doc_id % 40) || CASE WHEN doc_id % 11 = 0 THEN ' plain' ELSE '' END
             END AS hashtags,
             n_chars AS likes, n_chars // 5 AS retweets, n_chars // 20 AS replies,
             CASE WHEN doc_id % 33 = 0 THEN 0 ELSE n_chars * 10 END AS impressions,
             lang AS language, 'client-' || (doc_id % 4) AS source
      FROM documents)""")

VIEWS["mentions"] = (("social_posts",), """
SELECT tweet_id, tag AS hashtag, dt, likes, retweets, engagement_rate, post_ts
FROM (SELECT *, unnest(string_split_regex(trim(hashtags), '[ ]+')) AS tag FROM social_posts)
WHERE starts_with(tag, '#')""")

VIEWS["sensor_daily_summary"] = (("sendings", "typed_sendings", "sensor_readings"), f"""
SELECT device_id, zone, {rnd("avg(temperature)", 4)} AS avg_temp, min(temperature) AS min_temp, max(temperature) AS max_temp,
       {rnd("avg(humidity)", 4)} AS avg_humidity, count(*) AS total_readings,
       count(*) FILTER (status = 'ANOMALY') AS anomaly_count, count(*) FILTER (status = 'MISSING') AS missing_count, dt
FROM sensor_readings WHERE temperature + humidity IS NOT NULL GROUP BY ALL""")

VIEWS["trending_hashtags_daily"] = (("social_posts", "mentions"), f"""
SELECT hashtag, count(*) AS mention_count, {big("sum(likes)")} AS total_likes, {big("sum(retweets)")} AS total_retweets,
       {rnd("avg(engagement_rate)", 6)} AS avg_engagement_rate, min(post_ts) AS first_seen, max(post_ts) AS last_seen, dt
FROM mentions GROUP BY ALL""")


def with_views(sql: str, *needed: str) -> str:
    """Put the named views, and those they rest on, in front of a query."""
    wanted: list[str] = []
    for name in needed:
        for v in (*VIEWS[name][0], name):
            if v not in wanted:
                wanted.append(v)
    defined = ",\n".join(f"{v} AS MATERIALIZED ({VIEWS[v][1]})" for v in wanted)
    return f"WITH {defined}\n{sql}"
