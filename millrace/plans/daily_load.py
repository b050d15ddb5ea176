"""The load in order: raw sources to tables, summaries, statistics, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import size_shuffles
from ..sources import catalog, raw
from ..sources.sinks import csv_export, folder_bytes, in_parallel, overwrite_table
from ..tables import Tables, catalog_tables
from . import curate, incremental, rollups, sensors, social, web

STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "web_traffic": curate.web_traffic,
    "sensor_readings": curate.sensor_readings,
    "social_posts": curate.social_posts,
    "device_metadata": curate.device_metadata,
}

# CSV reports by folder name, and whether their row count is fixed.
REPORTS: dict[str, tuple[Callable[[Tables], DataFrame], bool]] = {
    "hourly_traffic": (web.hourly_path_status, False),
    "trending_hashtags": (social.top_hashtag_days, True),
    "sensor_anomalies": (sensors.anomalies_with_device, False),
    "daily_rollups": (rollups.grouping_sets_report, False),
    "sensor_device_summary": (sensors.device_summary, False),
}


def landing_zone(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Scans of the four landing folders, by the table they feed."""
    at = {name: f"{root}/raw/{folder}" for name, folder in catalog.RAW_FOLDERS.items()}
    return {
        "web_traffic": raw.scan_clf(spark, at["raw_web_logs"]),
        "sensor_readings": raw.scan_sensor_csv(spark, at["raw_sensor_readings"]),
        "social_posts": raw.scan_social_csv(spark, at["raw_social_posts"], escape='"'),
        "device_metadata": raw.scan_device_csv(spark, at["raw_device_metadata"]),
    }


def load(
    spark: SparkSession, sources: dict[str, DataFrame], database: str = catalog.PROCESSED_DB,
    days: tuple[str, str] | None = None,
) -> None:
    """Load the given sources, then the daily summaries that rest on them.

    ``days`` (first and last, as texts) limits tables with days to these. The
    other days stay as they are: a nightly load writes its own days only, and
    days that retention dropped stay away.
    """
    def within(df: DataFrame) -> DataFrame:
        return df.filter(F.col("dt").between(*days)) if days and "dt" in df.columns else df

    in_parallel([
        lambda name=name, df=df: overwrite_table(within(STEPS[name](df)), name, database) for name, df in sources.items()
    ])
    stored = catalog_tables(spark, database)
    summaries = []
    if "sensor_readings" in sources:
        summaries.append(lambda: overwrite_table(
            curate.sensor_daily_summary(within(stored.sensor_readings)), "sensor_daily_summary", database))
    if "social_posts" in sources:
        summaries.append(lambda: overwrite_table(
            curate.trending_hashtags_daily(within(stored.social_posts)), "trending_hashtags_daily", database))
    in_parallel(summaries)


def export_reports(tables: Tables, output_root: str) -> dict[str, int]:
    """Write the CSV reports; returns the rows of each."""
    return {
        name: csv_export(report(tables), f"{output_root}/{name}", single_file=fixed)
        for name, (report, fixed) in REPORTS.items()
    }


def run(
    spark: SparkSession, root: str, input_bytes: int | None = None, days: tuple[str, str] | None = None,
    only_new: bool = False,
) -> dict[str, int]:
    """Databases, tables, load, statistics and reports under one root folder.

    ``input_bytes``, by default the size of the landing zone, sets the width of
    the shuffles; ``days`` as in ``load``. ``only_new`` scans only files that landed since
    the last such load and rewrites their days (``incremental``).
    """
    size_shuffles(spark, folder_bytes(spark, f"{root}/raw") if input_bytes is None else input_bytes)
    catalog.create_databases(spark, root)
    catalog.create_raw_tables(spark, root)
    catalog.create_processed_tables(spark)
    if only_new:
        incremental.load_new_files(spark, root)
    else:
        load(spark, landing_zone(spark, root), days=days)
    catalog.analyze_all(spark)
    catalog.analyze_raw(spark)
    return export_reports(catalog_tables(spark), f"{root}/output")
