"""The plans hold their shape: what is shuffled, broadcast and pruned."""

from pathlib import Path

import pytest

from millrace.plans import dashboards, relational, rollups, sensors, social, web
from millrace.registry import QUERIES
from millrace.session import shared_folder, size_shuffles

from conftest import SMALL, plan_of


def test_dedup_limits_before_the_shuffle(small_tables):
    plan = plan_of(small_tables.sensor_readings)
    assert plan.count("WindowGroupLimit (") >= 2
    assert plan.count("Exchange (") == 1


def test_ranks_do_not_gather_the_rows(small_tables):
    """Only the histogram of totals passes through the single-task window."""
    plan = plan_of(relational.rank_of_sum(small_tables))
    single = plan.split("SinglePartition")[0]
    assert "_ties" in single.rsplit("Input [", 1)[1]


def test_estimates_are_near_the_exact_counts(small_tables):
    exact = {r.dt: r.unique_ips for r in relational.count_distinct(small_tables).collect()}
    near = {r.dt: (r.unique_ips, r.estimate_is_near) for r in relational.count_distinct_estimate(small_tables).collect()}
    assert near == {d: (n, True) for d, n in exact.items()}


def test_any_rows_are_rows_of_the_table(small_tables):
    assert relational.limit_sample(small_tables, 7).collect() == [(7, 7)]


def test_top_lists_do_not_sort_in_full(small_tables):
    for plan in (web.top_urls, social.trending, sensors.threshold_alerts, relational.topk):
        assert "TakeOrderedAndProject" in plan_of(plan(small_tables))


def test_device_report_groups_before_it_joins(small_tables):
    plan = sensors.daily_device_report(small_tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate [dt")


def test_scans_read_only_the_needed_columns(spark):
    plan = plan_of(QUERIES["q5b_rollup"](spark, SMALL))
    (schema,) = {line for line in plan.splitlines() if line.startswith("ReadSchema")}
    assert schema == "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>"


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 10 * 2**40) == 40960
        assert size_shuffles(spark, 100 * 2**40) == 409600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("plan", [relational.sum_avg_min_max, relational.skew_two_pass, rollups.weekly, dashboards.current_status])
def test_facts_are_hashed_not_sorted(small_tables, plan):
    assert "SortAggregate" not in plan_of(plan(small_tables))


@pytest.mark.parametrize("plan", [sensors.breach_figures, relational.join_skew])
def test_breaches_take_one_scan_of_the_fact(small_tables, plan):
    """The registry and the readings both come from the events table."""
    apart = plan_of(small_tables.sensor_readings.select("device_id")).count("Scan parquet") + plan_of(small_tables.device_metadata).count("Scan parquet")
    assert plan_of(plan(small_tables)).count("Scan parquet") <= apart


@pytest.mark.parametrize("name", ["q3c_rank_compare", "w_row_number_global", "scan_clf_files", "scan_sensor_csv", "scan_social_csv", "scan_device_csv", "csv_tsv_formats", "dynpart_overwrite"])
def test_queries_leave_no_files_of_their_own(spark, name):
    """What is left in the shared folder are Spark's checkpoints (folders with a rdd- inside)."""
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("*"))
    assert QUERIES[name](spark, SMALL).count() > 0
    assert all(any(x.name.startswith("rdd-") for x in p.iterdir()) for p in set(folder.glob("*")) - before if p.is_dir())
