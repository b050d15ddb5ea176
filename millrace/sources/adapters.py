"""The four raw sources, derived from the star-schema test tables.

``events`` gives access log lines and sensor readings, ``supplier`` with
``nation`` the device registry, ``documents`` the social posts. All rules use
integer and decimal arithmetic, so any engine gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed_values as V
from ..functions.labels import first_match

RESENT_OFFSET = 1_000_000_000

TIERS = list(V.SLA_TARGETS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _numbered(prefix: str, index: Column) -> Column:
    """A made-up name: prefix and number."""
    return F.concat(F.lit(prefix), index.cast("string"))


def _zone(index: Column) -> Column:
    """Six zones, the first of which a query asks for by name."""
    return F.when(index % 6 == 0, F.lit(V.WATCHED_ZONE)).otherwise(_numbered("zone-", index % 6))


def _padded(number: Column, prefix: str) -> Column:
    """Prefix and the number with five digits at least."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.repeat(F.lit("0"), F.lit(5) - F.length(text)), text)


def _floor_div(a: Column, n: int) -> Column:
    return ((a - F.pmod(a, F.lit(n))) / F.lit(n)).cast("bigint")


def web_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One access log line per event, column ``value``."""
    i, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    k = F.col("k")
    prefix = _pick(["192.168.", "10.0.", "172.16."], user % 3)
    ip = F.concat(prefix, (user % 256).cast("string"), F.lit("."), (_floor_div(user, 256) + 1).cast("string"))
    method = first_match([(i % 10 <= 6, "GET"), (i % 10 <= 8, "POST")], "PUT")
    url = first_match(
        [
            (i % 41 == 0, "/favicon.ico"),
            (i % 3 == 0, F.concat(F.lit("/"), kind)),
            (i % 7 == 0, F.concat(F.lit("/"), kind, F.lit("?k="), k, F.lit("?x"))),
        ],
        F.concat(F.lit("/"), kind, F.lit("/"), (user % 5).cast("string"), F.lit("?k="), k),
    )
    s = i % 20
    status = first_match(
        [(s <= 11, "200"), (s <= 13, "304"), (s == 14, "301"), (s <= 16, "404"), (s == 17, "403"), (s == 18, "500")],
        "503",
    )
    cents = (F.col("value").cast("decimal(18,2)") * 100).cast("bigint").cast("string")
    size = F.when(i % 97 == 0, F.lit("-")).otherwise(cents)
    referrer = F.when(i % 4 == 0, F.lit("https://www.example.com/")).otherwise(F.lit("-"))
    line = F.concat(
        ip, F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "'),
        method, F.lit(" "), url, F.lit(' HTTP/1.1" '), status, F.lit(" "), size,
        F.lit(' "'), referrer, F.lit('" "ua/'), (user % 10).cast("string"), F.lit('"'),
    )
    broken = F.concat(F.lit("garbage "), i.cast("string"))
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return events.select(F.when(i % 499 == 0, broken).otherwise(line).alias("value"))


def raw_sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns; every fiftieth reading is sent twice under a second id."""
    i, user = F.col("event_id"), F.col("user_id")
    blank = i % 200 == 0
    temperature = (F.col("value").cast("decimal(18,2)") * F.lit(0.6).cast("decimal(2,1)")
                   - F.lit(41.5).cast("decimal(3,1)")).cast("decimal(18,2)")
    humidity = ((i * 7919 % 1300).cast("decimal(18,1)") / F.lit(10).cast("decimal(2,0)")
                - F.lit(15).cast("decimal(2,0)")).cast("decimal(18,1)")
    t, h = F.col("t"), F.col("h")
    status = first_match(
        [(F.col("blank"), "MISSING"), ((t > 100) | (t < -40) | (h > 100) | (h < 0), "ANOMALY")], "OK"
    )
    first, second = i.cast("string"), (i + RESENT_OFFSET).cast("string")
    sends = F.when(i % 50 == 0, F.array(first, second)).otherwise(F.array(first))
    base = table(spark, sf_dir, "events").select(
        sends.alias("sends"), user.alias("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        temperature.alias("t"), humidity.alias("h"), blank.alias("blank"), (i % 500 == 0).alias("flagged"),
    )
    user = F.col("user_id")
    return base.select(
        F.explode("sends").alias("reading_id"),
        _padded(user, "SENSOR-").alias("device_id"),
        _numbered("site-", user % 8).alias("location"),
        _zone(user).alias("zone"),
        "ts",
        F.when(F.col("blank"), F.lit("")).otherwise(t.cast("string")).alias("temperature"),
        F.when(F.col("blank"), F.lit("")).otherwise(h.cast("string")).alias("humidity"),
        status.alias("status"),
        F.when(F.col("flagged"), F.lit("True")).otherwise(F.lit("False")).alias("is_duplicate"),
    )


def raw_device_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    k = s * 2
    text = lambda c: c.cast("string")
    start = F.lit("2022-01-01").cast("date")
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        _padded(k, "SENSOR-").alias("device_id"),
        F.col("s_name").alias("device_name"),
        F.concat(F.lit("M"), text(s % 7)).alias("model"),
        F.concat(F.lit("v"), text(s % 3), F.lit("."), text(s % 10)).alias("firmware_version"),
        F.col("n_name").alias("manufacturer"),
        _numbered("site-", k % 8).alias("location"),
        _numbered("level-", s % 4).alias("floor"),
        _zone(k).alias("zone"),
        text((s % 90).cast("decimal(9,1)")).alias("latitude"),
        text((s % 180).cast("decimal(9,1)")).alias("longitude"),
        text(F.date_add(start, (s % 365).cast("int"))).alias("install_date"),
        text(F.date_add(start, (s % 365 + 400).cast("int"))).alias("last_maintenance"),
        F.when(s % 4 == 0, F.lit("")).otherwise(text(s * 37 % 101)).alias("battery_level_pct"),
        _numbered("link-", s % 5).alias("connectivity"),
        text(F.lit(3600) * (s % 4 + 1)).alias("sampling_interval_sec"),
        text((s % 5 - 20).cast("decimal(9,1)")).alias("alert_temp_min"),
        text((s % 5 + 20).cast("decimal(9,1)")).alias("alert_temp_max"),
        text((s % 5 + 20).cast("decimal(9,1)")).alias("alert_humidity_min"),
        text((s % 5 + 80).cast("decimal(9,1)")).alias("alert_humidity_max"),
        F.when(s % 9 == 0, F.lit("False")).otherwise(F.lit("True")).alias("active"),
        F.concat(F.lit("CC-"), text(s % 6)).alias("cost_center"),
        _pick(TIERS, s % 3).alias("sla_tier"),
    )


def raw_social_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, n = F.col("doc_id"), F.col("n_chars")
    zero, days, seconds = F.lit(0), (i % 30).cast("int"), (i * 37 % 86400)
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, zero, zero, seconds)
    tags = F.concat(
        F.lit("#"), F.col("lang"), F.lit(" #"), F.col("source"), F.lit("  #top"), (i % 40).cast("string"),
        F.when(i % 11 == 0, F.lit(" plain")).otherwise(F.lit("")),
    )
    text = lambda c: c.cast("string")
    return table(spark, sf_dir, "documents").select(
        text(i).alias("tweet_id"),
        _padded(i % 97, "user_").alias("username"),
        _numbered("group-", i % 5).alias("user_type"),
        text(i * 7919 % 100000).alias("followers"),
        F.when(i % 10 == 0, F.lit("True")).otherwise(F.lit("False")).alias("verified"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.col("text").alias("post_text"),
        F.when(i % 25 == 0, F.lit("")).otherwise(tags).alias("hashtags"),
        text(n).alias("likes"),
        text(_floor_div(n, 5)).alias("retweets"),
        text(_floor_div(n, 20)).alias("replies"),
        F.when(i % 33 == 0, F.lit("0")).otherwise(text(n * 10)).alias("impressions"),
        F.col("lang").alias("language"),
        _numbered("client-", i % 4).alias("source"),
    )
