"""Headline timings as one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. The
load steps go from the raw sources to the stored tables; the queries then run
on those tables, as they would after a nightly load. Everything runs twice;
the second run counts, the first is listed under "cold".
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from millrace.plans import curate
from millrace.registry import TABLE_PLANS
from millrace.session import build_session
from millrace.sources import catalog
from millrace.sources.sinks import overwrite_table
from millrace.tables import catalog_tables, derived_tables

LOADS = ("web_traffic", "sensor_readings", "social_posts", "device_metadata")
QUERIES = (
    "q1a_anomaly_types", "q1b_anomaly_rate", "q2a_hourly_status", "q2b_top_urls", "q2c_heatmap", "q3a_trending",
    "q3b_trend_delta", "q3c_rank_compare", "q4a_threshold_alerts", "q4b_device_health", "q5a_grouping_sets",
    "q5b_rollup", "q5c_weekly", "q_explain_web", "q_explain_sensor", "d1_web_hourly", "d2_sensor_daily",
    "d3_hashtag_trends", "d3_user_engagement", "d4_exec_kpi", "x1_hourly_traffic", "x2_trending_top20",
    "x3_sensor_anomalies", "x4_daily_rollups", "x5_sensor_device", "p_word_frequency", "p_sla_compliance",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    root = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "millrace-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="12g",
        spark__sql__warehouse__dir=f"{root}/warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.create_databases(spark, root)
    catalog.create_processed_tables(spark, bucketed=False)
    seconds: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(name: str, work) -> None:
        for kept in (cold, seconds):
            start = time.perf_counter()
            work()
            kept[name] = round(time.perf_counter() - start, 3)

    derived, stored = derived_tables(spark, sf_dir), catalog_tables(spark)
    for name in LOADS:
        timed(f"load_{name}", lambda: overwrite_table(getattr(derived, name), name))
    timed("load_sensor_daily_summary", lambda: overwrite_table(
        curate.sensor_daily_summary(stored.sensor_readings), "sensor_daily_summary"))
    timed("load_trending_hashtags_daily", lambda: overwrite_table(
        curate.trending_hashtags_daily(stored.social_posts), "trending_hashtags_daily"))
    timed("analyze", lambda: catalog.analyze_all(spark))
    for name in QUERIES:
        timed(name, lambda: TABLE_PLANS[name](stored).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total seconds of load and queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "cold": cold, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
