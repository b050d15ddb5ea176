"""One small query per relational operator, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.labels import day_name, first_match, humidity_breach, no_reading, out_of_range, quality_score, temp_breach
from ..functions.measures import count_where, half_up, mean, percent, rows
from ..functions.texts import hashtag_tokens, log_time
from ..operators.distinct import bitmaps, dictionary, distinct_by_grain
from ..operators.ranking import number_rows, rank_by_measure, rank_by_range
from ..operators.sampling import digest_sample, sampled
from ..operators.skew import skew_join, two_pass_groupby
from ..operators.toplists import keep_top_keys, top
from ..tables import Tables
from .curate import first_received, hashtag_mentions
from .social import hashtag_totals

FIRST_DAY, LAST_DAY = "2024-01-15", "2024-01-20"


# -- projections and filters -------------------------------------------


def select_alias(t: Tables) -> DataFrame:
    return t.web_traffic.select(F.col("client_ip").alias("visitor"), F.col("url_path").alias("page"), "http_status")


def select_star_subquery(raw_readings: DataFrame) -> DataFrame:
    """All columns of a subquery and one expression more."""
    return first_received(raw_readings).select("*", quality_score().alias("data_quality_score"))


def literal_columns(t: Tables) -> DataFrame:
    return t.social_posts.select("dt", F.lit(V.SOURCE_SOCIAL).alias("data_source"), "tweet_id")


def reserved_name(t: Tables) -> DataFrame:
    return t.device_metadata.groupBy("floor").agg(rows().alias("devices"))


def not_null(t: Tables) -> DataFrame:
    return t.sensor_readings.filter(F.col("temperature").isNotNull() & F.col("humidity").isNotNull()).select(
        "reading_id", "temperature", "humidity"
    )


def null_or_range(t: Tables) -> DataFrame:
    return t.sensor_readings.filter(no_reading() | out_of_range()).select("reading_id", "temperature", "humidity")


def equal_not_equal(t: Tables) -> DataFrame:
    return t.sensor_readings.filter((F.col("status") != V.STATUS_MISSING) & (F.col("zone") == V.WATCHED_ZONE)).select(
        "reading_id", "status", "zone"
    )


def in_list(t: Tables) -> DataFrame:
    return t.sensor_readings.filter(F.col("status").isin(V.STATUS_ANOMALY, V.STATUS_MISSING)).select("reading_id", "status")


def not_in_list(t: Tables) -> DataFrame:
    return t.web_traffic.filter(~F.col("url_path").isin(V.NOISE_PATHS)).groupBy("url_path").agg(rows().alias("requests"))


def in_subquery(t: Tables) -> DataFrame:
    """Daily rows of the five most mentioned hashtags."""
    return keep_top_keys(t.trending_hashtags_daily, "hashtag", "mention_count", 5).select("hashtag", "dt", "mention_count")


def between(t: Tables) -> DataFrame:
    return t.web_traffic.filter(F.col("http_status").between(400, 499)).groupBy("http_status").agg(rows().alias("requests"))


def regex_filter(t: Tables) -> DataFrame:
    """Number of tokens that are tags, and of those that are not."""
    tokens = t.social_posts.select(F.explode(hashtag_tokens(F.col("hashtags"))).alias("token"))
    return tokens.groupBy(F.col("token").rlike("^#").alias("is_tag")).agg(rows().alias("tokens"))


def partition_range(t: Tables) -> DataFrame:
    return t.sensor_readings.filter(F.col("dt").between(FIRST_DAY, LAST_DAY)).groupBy("dt").agg(rows().alias("readings"))


def having(t: Tables) -> DataFrame:
    return (
        t.web_traffic.groupBy("url_path").agg(rows().alias("requests")).filter(F.col("requests") >= V.MIN_PATH_REQUESTS)
    )


def rank_filter(t: Tables) -> DataFrame:
    """Hashtags with most mentions of each day, all ties."""
    listed = t.trending_hashtags_daily.select("dt", "hashtag", "mention_count")
    return rank_by_measure(listed, "mention_count", within=["dt"], rank="daily_rank", top=1)


def case_searched(t: Tables) -> DataFrame:
    score = F.col("data_quality_score")
    level = first_match([(score >= 1, "good"), (score > 0, "usable")], "invalid")
    return t.sensor_readings.groupBy(level.alias("quality")).agg(rows().alias("readings"))


def case_simple(t: Tables) -> DataFrame:
    return t.web_traffic.groupBy(day_name(F.col("request_dow")).alias("day_name")).agg(rows().alias("requests"))


def derived_table(t: Tables) -> DataFrame:
    """Largest daily mention count per hashtag, listed for the hashtags with more than one day."""
    per_tag = t.trending_hashtags_daily.groupBy("hashtag").agg(
        rows().alias("days"), F.max("mention_count").alias("most_mentions")
    )
    return per_tag.filter(F.col("days") > 1)


def common_table(t: Tables) -> DataFrame:
    """Daily anomalies next to those of the listed day before."""
    daily = t.sensor_daily_summary.groupBy("dt").agg(F.sum("anomaly_count").alias("anomalies"))
    by_day = Window.orderBy("dt")  # one row per day
    return daily.withColumn("day_before", F.lag("anomalies").over(by_day))


# -- joins -------------------------------------------------------------


def join_inner(t: Tables) -> DataFrame:
    return t.sensor_readings.select("reading_id", "device_id", "temperature").join(
        t.device_metadata.select("device_id", "device_name", "sla_tier"), "device_id"
    )


def join_left_outer(t: Tables) -> DataFrame:
    """Readings per registered device; a silent device counts 0."""
    counts = t.sensor_readings.groupBy("device_id").agg(F.count("reading_id").alias("n"))
    return t.device_metadata.select("device_id", "zone").join(counts, "device_id", "left").select(
        "device_id", "zone", F.coalesce("n", F.lit(0)).alias("total_readings")
    )


def join_broadcast(t: Tables) -> DataFrame:
    """Readings per tier; Spark broadcasts the registry below its size limit."""
    return (
        t.sensor_readings.select("device_id")
        .join(t.device_metadata.select("device_id", "sla_tier"), "device_id")
        .groupBy("sla_tier").agg(rows().alias("readings"))
    )


def join_shuffle(t: Tables) -> DataFrame:
    """The same by a sort-merge join, as for two large sides."""
    return (
        t.sensor_readings.select("device_id")
        .join(t.device_metadata.select("device_id", "manufacturer").hint("merge"), "device_id")
        .groupBy("manufacturer").agg(rows().alias("readings"))
    )


def join_skew(t: Tables) -> DataFrame:
    """Mean temperature per tier; hot devices are split at run time."""
    joined = skew_join(
        t.sensor_readings.select("device_id", "reading_id", "temperature"),
        t.device_metadata.select("device_id", "sla_tier"), "device_id", ["reading_id"],
    )
    return joined.groupBy("sla_tier").agg(rows().alias("readings"), half_up(mean("temperature"), 2).alias("avg_temp"))


def join_inequality(t: Tables) -> DataFrame:
    """Breaches of the devices' own thresholds by tier."""
    joined = t.sensor_readings.join(
        t.device_metadata.select(
            "device_id", "sla_tier", "alert_temp_min", "alert_temp_max", "alert_humidity_min", "alert_humidity_max"
        ),
        "device_id",
    )
    return joined.groupBy("sla_tier").agg(
        count_where(temp_breach()).alias("temp_breaches"), count_where(humidity_breach()).alias("humidity_breaches")
    )


# -- aggregates --------------------------------------------------------


def hash_groupby(t: Tables) -> DataFrame:
    return t.web_traffic.groupBy("http_method", "http_status").agg(rows().alias("requests"))


def groupby_expression(t: Tables) -> DataFrame:
    return t.sensor_daily_summary.groupBy(F.weekofyear(F.col("dt").try_cast("date")).alias("week_number")).agg(
        F.sum("total_readings").alias("readings")
    )


def count_star_and_column(t: Tables) -> DataFrame:
    return t.sensor_readings.groupBy("zone").agg(
        rows().alias("all_rows"), F.count("temperature").alias("with_temperature")
    )


def count_distinct(t: Tables) -> DataFrame:
    return t.web_traffic.groupBy("dt").agg(F.countDistinct("client_ip").alias("unique_ips"))


def count_distinct_estimate(t: Tables) -> DataFrame:
    """The exact count, and whether the estimate offered beside it lies within three of its standard errors."""
    error = 0.02
    exact, estimate = F.countDistinct("client_ip"), F.approx_count_distinct("client_ip", error)
    near = F.abs(estimate - exact) <= F.greatest(exact * (3 * error), F.lit(1.0))
    return t.web_traffic.groupBy("dt").agg(exact.alias("unique_ips"), near.alias("estimate_is_near"))


def sum_avg_min_max(t: Tables) -> DataFrame:
    return t.web_traffic.groupBy("http_method").agg(
        F.sum("response_bytes").alias("sum_bytes"), half_up(mean("response_bytes"), 4).alias("avg_bytes"),
        F.min("request_ts").alias("first_ts"), F.max("request_ts").alias("last_ts"),
        # Dates have a fixed width and so are hashed; a text would sort the whole fact.
        F.min(F.col("dt").cast("date")).cast("string").alias("first_dt"), F.max(F.col("dt").cast("date")).cast("string").alias("last_dt"),
    )


def conditional_sum(t: Tables) -> DataFrame:
    return t.web_traffic.groupBy("dt").agg(
        count_where(F.col("http_status") == 200).alias("ok"), count_where(F.col("http_status") >= 500).alias("failed")
    )


def ratio_percent(t: Tables) -> DataFrame:
    return t.web_traffic.groupBy("http_method").agg(
        half_up(percent(count_where(F.col("http_status") >= 400), rows()), 2).alias("error_rate_pct")
    )


def safe_ratio(t: Tables) -> DataFrame:
    """Interactions per impression, days without impressions included."""
    actions = F.sum("likes") + F.sum("retweets")
    return t.social_posts.groupBy("username").agg(
        half_up(actions / F.greatest(F.sum("impressions"), F.lit(1)), 6).alias("rate")
    )


def aggregate_of_aggregate(t: Tables) -> DataFrame:
    """Plain mean of daily means per zone."""
    return t.sensor_daily_summary.groupBy("zone").agg(
        F.sum("total_readings").alias("readings"), half_up(mean("avg_temp"), 2).alias("mean_of_means"),
        F.min("min_temp").alias("lowest"), F.max("max_temp").alias("highest"),
    )


def case_over_aggregate(t: Tables) -> DataFrame:
    peak, quality = F.max("temperature"), mean("data_quality_score")
    state = first_match([(peak > V.TEMP_MAX, "hot"), (quality < V.LOW_QUALITY_BELOW, "poor")], "fine")
    return t.sensor_readings.groupBy("device_id").agg(state.alias("state"))


def skew_two_pass(t: Tables, salts: int = 64) -> DataFrame:
    """Requests and exact distinct visitors per status in two passes: distinct rows spread by visitor, then counts."""
    return two_pass_groupby(
        t.web_traffic.groupBy("http_status", "client_ip").agg(rows().alias("n")), ["http_status"],
        [F.sum("n").alias("n"), rows().alias("ips")],
        [F.sum("n").alias("requests"), F.sum("ips").alias("unique_ips")],
        spread=["client_ip"], salts=salts,
    )


# -- windows -----------------------------------------------------------


def dedup(raw_readings: DataFrame) -> DataFrame:
    """Lowest reading id per device and time."""
    return first_received(raw_readings).select("device_id", "ts", "reading_id")


def lag(t: Tables) -> DataFrame:
    by_day = Window.partitionBy("hashtag").orderBy("dt")
    return t.trending_hashtags_daily.select(
        "hashtag", "dt", "mention_count", F.lag("mention_count", 1).over(by_day).alias("prev_mentions")
    )


def rank_all(t: Tables) -> DataFrame:
    return rank_by_range(hashtag_totals(t), "total_mentions", rank="mention_rank")


def dense_rank_all(t: Tables) -> DataFrame:
    return rank_by_range(hashtag_totals(t), "total_mentions", dense_rank="mention_dense_rank").drop("rank")


def row_number_all(t: Tables) -> DataFrame:
    return number_rows(hashtag_totals(t), [-F.col("total_mentions"), F.col("hashtag")], "row_num")


def percent_rank_all(t: Tables) -> DataFrame:
    ranked = rank_by_range(hashtag_totals(t), "total_mentions", percent_rank="pr")
    return ranked.select("hashtag", "total_mentions", half_up(F.col("pr"), 4).alias("percentile"))


def rank_of_readings(t: Tables) -> DataFrame:
    """Readings by temperature, a measure with many values and NULLs."""
    readings = t.sensor_readings.select("reading_id", "temperature")
    ranked = rank_by_range(readings, "temperature", dense_rank="dense", percent_rank="pr")
    return ranked.withColumn("pr", half_up(F.col("pr"), 6))


def visitors_by_grain(t: Tables) -> DataFrame:
    """Visitors per hour, per day and in all, from the bitmaps of hours."""
    traffic, by = t.web_traffic.select("client_ip", "dt", "request_hour"), ["dt", "request_hour"]
    hourly = bitmaps(traffic, "client_ip", dictionary(traffic, "client_ip"), by)
    return distinct_by_grain(hourly, by, [by, ["dt"], []], "unique_visitors").select(
        F.coalesce("dt", F.lit("ALL")).alias("dt"), F.coalesce("request_hour", F.lit(-1)).alias("request_hour"), "unique_visitors")


def rank_per_day(t: Tables) -> DataFrame:
    listed = t.trending_hashtags_daily.select("dt", "hashtag", "mention_count")
    return rank_by_measure(listed, "mention_count", within=["dt"], rank="daily_rank")


def sum_per_key(t: Tables) -> DataFrame:
    return t.trending_hashtags_daily.select(
        "dt", "hashtag", F.sum("mention_count").over(Window.partitionBy("hashtag")).alias("hashtag_total")
    )


def rank_of_sum(t: Tables) -> DataFrame:
    """Rank of each row by the total of its hashtag."""
    ranked = rank_by_measure(sum_per_key(t), "hashtag_total", rank="overall_rank")
    return ranked.select("dt", "hashtag", "hashtag_total", "overall_rank")


def rolling_rows(t: Tables) -> DataFrame:
    """Sum over the last seven listed days."""
    last = Window.partitionBy("hashtag").orderBy("dt").rowsBetween(-6, 0)
    return t.trending_hashtags_daily.select("dt", "hashtag", F.sum("mention_count").over(last).alias("rolling_7_rows"))


def rolling_days(t: Tables) -> DataFrame:
    """Sum over the last seven calendar days, gaps or not."""
    day_no = F.unix_date(F.col("dt").try_cast("date"))
    last = Window.partitionBy("hashtag").orderBy("day_no").rangeBetween(-6, 0)
    return t.trending_hashtags_daily.withColumn("day_no", day_no).select(
        "dt", "hashtag", F.sum("mention_count").over(last).alias("rolling_7_days")
    )


def cumulative(t: Tables) -> DataFrame:
    """Running mentions per hashtag."""
    so_far = Window.partitionBy("hashtag").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return t.trending_hashtags_daily.select("dt", "hashtag", F.sum("mention_count").over(so_far).alias("mentions_so_far"))


# -- sorts and limits --------------------------------------------------


def sort_multi(t: Tables) -> DataFrame:
    return t.device_metadata.select("device_id", "zone", "sla_tier").orderBy("sla_tier", F.desc("zone"), "device_id")


def sort_nulls_last(t: Tables) -> DataFrame:
    """All devices by battery level with their place, mains-powered ones after all others."""
    level = F.col("battery_level_pct")
    return number_rows(t.device_metadata.select("device_id", "battery_level_pct"), [level.isNull(), level, F.col("device_id")], "place")


def sort_default_nulls(t: Tables) -> DataFrame:
    """Ascending order puts NULL first; all devices with their place."""
    return number_rows(t.device_metadata.select("device_id", "battery_level_pct"), [F.col("battery_level_pct"), F.col("device_id")], "place")


def topk(t: Tables) -> DataFrame:
    sizes = t.web_traffic.groupBy("client_ip").agg(F.sum("response_bytes").alias("total_bytes"))
    return top(sizes, 15, F.desc("total_bytes"), "client_ip")


def topk_in_subquery(t: Tables) -> DataFrame:
    """Days and likes of the five most mentioned hashtags."""
    kept = keep_top_keys(t.trending_hashtags_daily, "hashtag", "mention_count", 5)
    return kept.groupBy("hashtag").agg(rows().alias("days"), F.sum("total_likes").alias("likes"))


def semi_topk(t: Tables) -> DataFrame:
    """Readings of the five devices with the emptiest batteries: rows of one table kept by keys of another."""
    weakest = top(t.device_metadata.filter("battery_level_pct is not null").select("device_id", "battery_level_pct"), 5, "battery_level_pct", "device_id")
    kept = t.sensor_readings.join(F.broadcast(weakest.select("device_id")), "device_id", "left_semi")  # five keys
    return kept.groupBy("device_id").agg(rows().alias("readings"), F.max("timestamp_ts").alias("last_ts"))


def limit_sample(t: Tables, k: int = 5) -> DataFrame:
    """Any k rows: how many come, and how many of them the table holds."""
    return sampled(t.web_traffic.select("client_ip", "url_path", "http_status"), k)


# -- sets, samples, scalars --------------------------------------------


def union_all(t: Tables) -> DataFrame:
    """Record counts per day of the three sources, one below the other."""
    parts = [
        (t.web_traffic, V.SOURCE_WEB), (t.sensor_readings, V.SOURCE_SENSORS), (t.social_posts, V.SOURCE_SOCIAL),
    ]
    counted = [d.groupBy("dt").agg(rows().alias("records")).withColumn("data_source", F.lit(name)) for d, name in parts]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).orderBy("dt", "data_source")


def client_bucket(t: Tables) -> DataFrame:
    """Requests of the visitors in bucket 1 of 32, by a digest that any engine has."""
    return digest_sample(t.web_traffic, "client_ip", 1, 32).groupBy("client_ip").agg(rows().alias("requests"))


def log_fields(raw_logs: DataFrame) -> DataFrame:
    """The nine fields of every log line; a broken line gives NULLs."""
    return raw_logs


def null_tokens(raw_logs: DataFrame) -> DataFrame:
    """How often ``-`` reads as NULL (ident, user) and how often it stays."""
    dash = F.lit("-")
    return raw_logs.agg(
        rows().alias("lines"),
        count_where(F.col("rfc_ident").isNull()).alias("null_ident"),
        count_where(F.col("auth_user").isNull()).alias("null_user"),
        count_where(F.col("referrer") == dash).alias("direct"),
        count_where(F.col("response_bytes") == dash).alias("no_body"),
    )


def request_parts(t: Tables) -> DataFrame:
    """Method, path, query and protocol combinations."""
    return t.web_traffic.groupBy("http_method", "url_path", "url_query", "http_protocol").agg(rows().alias("requests"))


def hashtag_sizes(t: Tables) -> DataFrame:
    """Posts by number of tokens; an empty text counts as one token."""
    return t.social_posts.groupBy("hashtag_count").agg(rows().alias("posts"))


def exploded_tags(t: Tables) -> DataFrame:
    return hashtag_mentions(t.social_posts).select("tweet_id", "hashtag")


def log_times(raw_logs: DataFrame) -> DataFrame:
    """Parsed time, hour, weekday and day of every log line."""
    ts = log_time(F.col("raw_timestamp"))
    return raw_logs.filter(F.col("raw_timestamp").isNotNull()).select(ts.alias("request_ts")).select(
        "request_ts", F.hour("request_ts").alias("request_hour"), F.dayofweek("request_ts").alias("request_dow"),
        F.col("request_ts").cast("date").cast("string").alias("dt"),
    )


def fahrenheit(t: Tables) -> DataFrame:
    """Arithmetic on columns: Celsius to Fahrenheit."""
    return t.sensor_readings.select("reading_id", half_up(F.col("temperature") * 9 / 5 + 32, 2).alias("temperature_f"))
