"""Hashtag trends and user engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import fixed_values as V
from ..functions.measures import half_up, mean, rows
from ..operators.ranking import rank_by_measure
from ..operators.toplists import keep_top_keys, top
from ..tables import Tables


def hashtag_totals(t: Tables) -> DataFrame:
    """Mentions per hashtag over all days."""
    return t.trending_hashtags_daily.groupBy("hashtag").agg(F.sum("mention_count").alias("total_mentions"))


def trending(t: Tables, k: int = 10) -> DataFrame:
    """Top hashtags by mentions weighted with likes and retweets.

    The engagement figure is the plain mean of the daily means: a quiet day
    weighs as much as a busy one.
    """
    totals = t.trending_hashtags_daily.groupBy("hashtag").agg(
        F.sum("mention_count").alias("total_mentions"),
        F.sum("total_likes").alias("total_likes"),
        F.sum("total_retweets").alias("total_retweets"),
        half_up(mean("avg_engagement_rate") * 100, 4).alias("avg_engagement_pct"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    score = (
        F.col("total_mentions")
        + F.col("total_likes") * F.lit(float(V.LIKE_WEIGHT))
        + F.col("total_retweets") * F.lit(float(V.RETWEET_WEIGHT))
    )
    return top(totals.withColumn("trending_score", half_up(score, 2)), k, F.desc("trending_score"), "hashtag")


def trend_delta(t: Tables, k: int = 5) -> DataFrame:
    """Change of mentions from one listed day to the next, for the top hashtags."""
    by_day = Window.partitionBy("hashtag").orderBy("dt")
    now = F.col("mention_count")
    before = F.col("prev_day_mentions")
    growth = F.when(before == 0, F.lit(100.0)).otherwise(F.try_divide((now - before) * 100, before))
    return (
        keep_top_keys(t.trending_hashtags_daily.select("hashtag", "dt", "mention_count"), "hashtag", "mention_count", k)
        .withColumn("prev_day_mentions", F.coalesce(F.lag("mention_count").over(by_day), F.lit(0).cast("bigint")))
        .select(
            "hashtag", "dt", "mention_count", "prev_day_mentions",
            (now - before).alias("daily_delta"), half_up(growth, 2).alias("growth_rate_pct"),
        )
        .orderBy("hashtag", "dt")
    )


def rank_comparison(t: Tables, k: int = 10) -> DataFrame:
    """The four rank functions side by side, for the hashtags of rank <= k."""
    ranked = rank_by_measure(
        hashtag_totals(t), "total_mentions", rank="mention_rank", dense_rank="dense_rank",
        percent_rank="percentile", top=k,
    )
    return (
        # A short list: ranks up to k with their ties.
        ranked.withColumn("row_num", F.row_number().over(Window.orderBy(F.desc("total_mentions"), "hashtag")).cast("bigint"))
        .select("hashtag", "total_mentions", "mention_rank", "dense_rank", "row_num",
                half_up(F.col("percentile"), 4).alias("percentile"))
        .orderBy("row_num")
    )


def hashtag_trends(t: Tables) -> DataFrame:
    """BI dataset: daily rank, overall rank and a sum over seven listed days.

    ``overall_rank`` ranks the rows by the total of their hashtag, so a
    hashtag takes as many places as it has days. The seven-row sum counts
    listed days, not calendar days.
    """
    by_day = Window.partitionBy("hashtag").orderBy("dt")
    daily = t.trending_hashtags_daily.select(
        F.col("dt").alias("trend_date"), "hashtag", "mention_count", "total_likes", "total_retweets",
        half_up(F.col("avg_engagement_rate") * 100, 4).alias("avg_engagement_pct"),
        F.sum("mention_count").over(by_day.rowsBetween(-6, 0)).alias("rolling_7d_mentions"),
        F.sum("mention_count").over(Window.partitionBy("hashtag")).alias("_total"),
    )
    ranked = rank_by_measure(daily, "mention_count", within=["trend_date"], rank="daily_rank")
    ranked = rank_by_measure(ranked, "_total", rank="overall_rank", of=daily)
    return ranked.select(
        "trend_date", "hashtag", "mention_count", "total_likes", "total_retweets", "avg_engagement_pct",
        "daily_rank", "overall_rank", "rolling_7d_mentions",
    ).orderBy("trend_date", F.desc("mention_count"), "hashtag")


def user_engagement(t: Tables) -> DataFrame:
    """BI dataset: posts and engagement by user type and day."""
    users, posts = F.countDistinct("username"), F.count("tweet_id")
    return (
        t.social_posts.groupBy("user_type", "dt")
        .agg(
            users.alias("unique_users"),
            posts.alias("total_posts"),
            F.sum("likes").alias("total_likes"),
            F.sum("retweets").alias("total_retweets"),
            F.sum("impressions").alias("total_impressions"),
            half_up(mean("engagement_rate") * 100, 4).alias("avg_engagement_pct"),
            half_up(mean("followers"), 0).alias("avg_followers"),
            half_up(mean("hashtag_count"), 2).alias("avg_hashtags_per_post"),
        )
        .withColumn("posts_per_user", half_up(F.col("total_posts") / F.col("unique_users"), 2))
        .select(
            "user_type", "dt", "unique_users", "total_posts", "total_likes", "total_retweets",
            "total_impressions", "avg_engagement_pct", "avg_followers", "posts_per_user", "avg_hashtags_per_post",
        )
        .orderBy("dt", "user_type")
    )


def top_hashtags(t: Tables, k: int, name: str) -> DataFrame:
    """The k most mentioned hashtags over all days."""
    totals = hashtag_totals(t).withColumnRenamed("total_mentions", name)
    return top(totals, k, F.desc(name), "hashtag")


def top_hashtag_days(t: Tables, k: int = 20) -> DataFrame:
    """CSV report: the hashtag-days with most mentions."""
    listed = t.trending_hashtags_daily
    leading = top(listed, k, F.desc("mention_count"), "hashtag", "dt")
    return leading.select(
        "hashtag", "mention_count", "total_likes", "total_retweets", "avg_engagement_rate", "first_seen", "last_seen"
    )
