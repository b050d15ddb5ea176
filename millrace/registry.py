"""Every registered query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.measures import half_up
from .operators.profiling import checked_cardinality, column_profile
from .plans import checks, curate, dashboards, relational as rel, rollups, roundtrips, sensors, social, web
from .sources import adapters, raw
from .tables import Tables, derived_tables

Query = Callable[[SparkSession, str], DataFrame]

PROFILE_COLUMNS = ["device_id", "temperature", "humidity", "status", "data_quality_score"]


def _on_tables(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(derived_tables(spark, sf_dir))


def _on_logs(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(raw.parse_log_lines(adapters.web_log_lines(spark, sf_dir)))


def _on_readings(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(raw.type_sensor(adapters.raw_sensor_readings(spark, sf_dir)))


def _on_posts(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(raw.type_social(adapters.raw_social_posts(spark, sf_dir)))


def _on_devices(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(raw.type_device(adapters.raw_device_metadata(spark, sf_dir)))


def _devices(t: Tables) -> DataFrame:
    """Dates as text, so every reader of the result gets the same values."""
    return t.device_metadata.withColumns({c: F.col(c).cast("string") for c in ("install_date", "last_maintenance")})


def _summary_variant(t: Tables) -> DataFrame:
    """The unrounded means, shown to nine digits: the last bits depend on the order of summing."""
    variant = curate.sensor_daily_summary(t.sensor_readings, rounded=False, need_humidity=False)
    return variant.withColumns({c: half_up(F.col(c), 9) for c in ("avg_temp", "avg_humidity")})


_RAW_ROWS = {
    "web_traffic": adapters.web_log_lines, "sensor_readings": adapters.raw_sensor_readings, "social_posts": adapters.raw_social_posts,
}


def _two_loads(load: Callable[[DataFrame, str, str], DataFrame], name: str, result: str) -> Query:
    return lambda spark, sf_dir: load(_RAW_ROWS[name](spark, sf_dir), name, result)


TABLE_PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    # processed tables
    "etl_web_traffic": lambda t: t.web_traffic,
    "etl_sensor_readings": lambda t: t.sensor_readings,
    "etl_social_posts": lambda t: t.social_posts,
    "etl_device_metadata": _devices,
    "etl_sensor_daily_summary": lambda t: t.sensor_daily_summary,
    "etl_trending_hashtags_daily": lambda t: t.trending_hashtags_daily,
    "etl_summary_variant": _summary_variant,
    # load checks
    "chk_web_by_day": checks.web_by_day,
    "chk_sensor_by_day_zone": checks.sensor_by_day_zone,
    "chk_social_by_lang_day": checks.social_by_language_day,
    "chk_device_loaded": checks.devices_loaded,
    "chk_top_hashtags": lambda t: social.top_hashtags(t, 15, "total_mentions"),
    # analytics
    "q1a_anomaly_types": sensors.anomaly_types,
    "q1b_anomaly_rate": sensors.anomaly_rate,
    "q2a_hourly_status": web.hourly_status,
    "q2b_top_urls": web.top_urls,
    "q2c_heatmap": web.heatmap,
    "q3a_trending": social.trending,
    "q3b_trend_delta": social.trend_delta,
    "q3c_rank_compare": social.rank_comparison,
    "q4a_threshold_alerts": sensors.threshold_alerts,
    "q4b_device_health": sensors.device_health,
    "q5a_grouping_sets": rollups.grouping_sets,
    "q5b_rollup": rollups.rollup,
    "q5c_weekly": rollups.weekly,
    "q5c_weekly_by_year": lambda t: rollups.weekly(t, with_year=True),
    "agg_cube": rollups.cube,
    "q_explain_web": web.day_top_urls,
    "q_explain_sensor": sensors.zone_day_temps,
    # BI datasets
    "d1_web_hourly": web.hourly_paths,
    "d2_sensor_daily": sensors.daily_device_report,
    "d3_hashtag_trends": social.hashtag_trends,
    "d3_user_engagement": social.user_engagement,
    "d4_exec_kpi": dashboards.executive_kpis,
    "d5_hashtag_top50": lambda t: social.top_hashtags(t, 50, "mentions"),
    "d5_anomaly_rows": sensors.anomaly_rows,
    # CSV reports
    "x1_hourly_traffic": web.hourly_path_status,
    "x2_trending_top20": social.top_hashtag_days,
    "x3_sensor_anomalies": sensors.anomalies_with_device,
    "x4_daily_rollups": rollups.grouping_sets_report,
    "x5_sensor_device": sensors.device_summary,
    # dashboards
    "p_status_distribution": dashboards.status_distribution,
    "p_top_pages": dashboards.top_pages,
    "p_temp_by_device_time": dashboards.temperature_by_hour,
    "p_current_status": dashboards.current_status,
    "p_temp_humidity_scatter": dashboards.temp_humidity_scatter,
    "p_device_scorecard": dashboards.device_scorecard,
    "p_location_heat": dashboards.location_heat,
    "p_engagement_timeline": dashboards.engagement_timeline,
    "p_word_frequency": dashboards.word_frequency,
    "p_influencers": dashboards.influencers,
    "p_posts_by_type_day": dashboards.posts_by_type_day,
    "p_kpi_cards": dashboards.kpi_cards,
    "p_requests_vs_anomalies": dashboards.requests_vs_anomalies,
    "p_sla_compliance": dashboards.sla_compliance,
    "p_volume_by_source": dashboards.volume_by_source,
    "p_ip_region": dashboards.ip_regions,
    # profiles and samples
    "column_profile": lambda t: column_profile(t.sensor_readings, PROFILE_COLUMNS),
    "column_cardinality": lambda t: checked_cardinality(t.sensor_readings, PROFILE_COLUMNS),
    "bucket_sample": rel.client_bucket,
    "bucket_sample_files": roundtrips.sampled_bucket_files,
    "column_statistics_daily": lambda t: roundtrips.merged_profile(t, PROFILE_COLUMNS),
    # projections and filters
    "p_select_alias": rel.select_alias,
    "p_literal_cols": rel.literal_columns,
    "p_backtick_ident": rel.reserved_name,
    "f_not_null": rel.not_null,
    "f_is_null_or_range": rel.null_or_range,
    "f_eq_neq": rel.equal_not_equal,
    "f_in_list": rel.in_list,
    "f_not_in_list": rel.not_in_list,
    "f_in_subquery": rel.in_subquery,
    "f_between": rel.between,
    "f_rlike": rel.regex_filter,
    "f_partition_range": rel.partition_range,
    "f_having": rel.having,
    "f_rank_filter": rel.rank_filter,
    "case_searched": rel.case_searched,
    "case_simple": rel.case_simple,
    "derived_table": rel.derived_table,
    "cte": rel.common_table,
    # joins
    "join_inner_equi": rel.join_inner,
    "join_left_outer": rel.join_left_outer,
    "join_map_broadcast": rel.join_broadcast,
    "join_common_shuffle": rel.join_shuffle,
    "join_skew": rel.join_skew,
    "join_inequality_post": rel.join_inequality,
    "join_semi_topk": rel.semi_topk,
    # aggregates
    "agg_hash_groupby": rel.hash_groupby,
    "agg_groupby_expr": rel.groupby_expression,
    "agg_count_star_col": rel.count_star_and_column,
    "agg_count_distinct": rel.count_distinct,
    "agg_count_distinct_grains": rel.visitors_by_grain,
    "agg_count_distinct_estimate": rel.count_distinct_estimate,
    "agg_sum_avg_min_max": rel.sum_avg_min_max,
    "agg_conditional_sum": rel.conditional_sum,
    "agg_ratio_pct": rel.ratio_percent,
    "agg_safe_ratio": rel.safe_ratio,
    "agg_of_agg": rel.aggregate_of_aggregate,
    "agg_case_over_agg": rel.case_over_aggregate,
    "agg_skew_two_pass": rel.skew_two_pass,
    # windows
    "w_lag": rel.lag,
    "w_rank_global": rel.rank_all,
    "w_dense_rank": rel.dense_rank_all,
    "w_row_number_global": rel.row_number_all,
    "w_percent_rank": rel.percent_rank_all,
    "w_rank_double": rel.rank_of_readings,
    "w_rank_partitioned": rel.rank_per_day,
    "w_sum_partition": rel.sum_per_key,
    "w_nested": rel.rank_of_sum,
    "w_rolling_rows": rel.rolling_rows,
    "w_rolling_days": rel.rolling_days,
    "w_cumulative": rel.cumulative,
    # sorts and limits
    "sort_multi": rel.sort_multi,
    "sort_nulls_last": rel.sort_nulls_last,
    "sort_default_nulls": rel.sort_default_nulls,
    "topk": rel.topk,
    "topk_in_subquery": rel.topk_in_subquery,
    "limit_sample": rel.limit_sample,
    # sinks
    "dynpart_overwrite": roundtrips.partition_overwrite,
    "csv_tsv_formats": roundtrips.tsv_report,
    **{f"write_{name}": partial(roundtrips.written_table, name=name) for name in (
        "web_traffic", "sensor_readings", "social_posts", "sensor_daily_summary", "trending_hashtags_daily")},
    "write_device_metadata": lambda t: roundtrips.plain_dates(roundtrips.written_table(t, "device_metadata")),
    "full_overwrite": roundtrips.replaced_registry,
    "multi_insert": roundtrips.several_tables,
    "delimited_dir_sink": roundtrips.delimited_report,
    "multi_insert_one_pass": roundtrips.readings_by_outcome,
    "compact_partition": roundtrips.compacted_readings,
    "compact_table": roundtrips.compacted_table,
    "retention_prune": roundtrips.pruned_traffic,
    "join_smb_bucket": roundtrips.bucketed_join,
    # sets and scalars
    "union_all_3": rel.union_all,
    "fn_request_parts": rel.request_parts,
    "fn_size_split": rel.hashtag_sizes,
    "fn_explode": rel.exploded_tags,
    "fn_arithmetic": rel.fahrenheit,
}

QUERIES: dict[str, Query] = {name: _on_tables(plan) for name, plan in TABLE_PLANS.items()} | {
    # raw sources
    "scan_clf": _on_logs(rel.log_fields),
    "null_token": _on_logs(rel.null_tokens),
    "fn_log_time": _on_logs(rel.log_times),
    "raw_string_typing": _on_readings(lambda df: df),
    "p_select_star_subq": _on_readings(rel.select_star_subquery),
    "w_row_number_dedup": _on_readings(rel.dedup),
    "scan_clf_files": lambda spark, sf_dir: roundtrips.log_files(adapters.web_log_lines(spark, sf_dir)),
    "archive_snapshot": lambda spark, sf_dir: roundtrips.archived_logs(adapters.web_log_lines(spark, sf_dir)),
    "archive_incremental": lambda spark, sf_dir: roundtrips.archived_additions(adapters.web_log_lines(spark, sf_dir)),
    "scan_sensor_csv": lambda spark, sf_dir: roundtrips.sensor_csv(adapters.raw_sensor_readings(spark, sf_dir)),
    "scan_social_csv": lambda spark, sf_dir: roundtrips.social_csv(adapters.raw_social_posts(spark, sf_dir)),
    "scan_social_csv_blocks": lambda spark, sf_dir: roundtrips.social_csv_in_blocks(adapters.raw_social_posts(spark, sf_dir)),
    "scan_device_csv": lambda spark, sf_dir: roundtrips.device_csv(adapters.raw_device_metadata(spark, sf_dir)),
    # loads of what arrived
    **{f"{kind}_{result}": _two_loads(load, name, result) for kind, load in (
        ("load_new", roundtrips.loaded_by_new_files), ("stream", roundtrips.streamed_by_days)) for name, result in (
        ("web_traffic", "web_traffic"), ("sensor_readings", "sensor_readings"), ("sensor_readings", "sensor_daily_summary"),
        ("social_posts", "social_posts"), ("social_posts", "trending_hashtags_daily"))},
    "load_new_device_metadata": lambda spark, sf_dir: roundtrips.plain_dates(
        roundtrips.loaded_by_new_files(adapters.raw_device_metadata(spark, sf_dir), "device_metadata")),
    "chk_weblog_sample": _on_logs(checks.log_sample),
    "chk_sensor_status_counts": _on_readings(checks.status_counts),
    "chk_social_user_type_counts": _on_posts(checks.user_type_counts),
    "chk_device_list": _on_devices(checks.device_list),
}
