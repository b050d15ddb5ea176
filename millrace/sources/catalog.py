"""Databases, table definitions, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

RAW_DB, PROCESSED_DB = "raw_db", "processed_db"


@dataclass(frozen=True)
class Layout:
    """How a processed table lies in storage."""

    partitions: tuple[str, ...] = ()
    bucket_column: str | None = None
    buckets: int = 0
    compress: str = "ZLIB"
    bloom: tuple[str, ...] = ()
    statistics: tuple[str, ...] = ()
    orc: dict[str, str] = field(default_factory=dict)


# Partition columns, bucket counts and ORC settings of the tables.
LAYOUTS = {
    "web_traffic": Layout(
        ("dt",), "client_ip", 32, bloom=("http_status", "http_method"),
        statistics=("client_ip", "http_method", "url_path", "http_status", "response_bytes", "request_hour"),
        orc={"orc.stripe.size": "67108864", "orc.row.index.stride": "10000"},
    ),
    "sensor_readings": Layout(
        ("dt", "zone"), "device_id", 16, bloom=("device_id", "status"),
        statistics=("device_id", "temperature", "humidity", "status", "data_quality_score"),
    ),
    "social_posts": Layout(("dt", "language"), compress="SNAPPY", bloom=("username", "user_type")),
    "device_metadata": Layout(statistics=("device_id", "zone", "sla_tier", "manufacturer")),
    "sensor_daily_summary": Layout(("dt",)),
    "trending_hashtags_daily": Layout(("dt",)),
}

RAW_FOLDERS = {
    "raw_web_logs": "web_logs",
    "raw_sensor_readings": "iot_sensors",
    "raw_social_posts": "social_media",
    "raw_device_metadata": "device_metadata",
}


def create_database(spark: SparkSession, name: str, location: str, comment: str, properties: dict[str, str]) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{location}' WITH DBPROPERTIES ({listed})"
    )


def create_databases(spark: SparkSession, root: str, raw_db: str = RAW_DB, processed_db: str = PROCESSED_DB) -> None:
    """The raw layer, kept for good, and the processed layer, kept for 90 days."""
    create_database(spark, raw_db, f"{root}/raw", "Landing zone, read as it is",
                    {"layer": "raw", "data_retention": "indefinite"})
    create_database(spark, processed_db, f"{root}/processed", "Typed and cleaned tables in ORC",
                    {"layer": "processed", "data_retention": "90_days"})


def create_raw_tables(spark: SparkSession, root: str, database: str = RAW_DB) -> None:
    """Tables over the landing folders; dropping one leaves its files.

    CSV columns are text here, as the files hold them. The log table has one
    column with the line; ``parse_log_lines`` reads its fields.
    """
    texts = {
        "raw_sensor_readings": schemas.RAW_SENSOR,
        "raw_social_posts": schemas.RAW_SOCIAL,
        "raw_device_metadata": schemas.RAW_DEVICE,
    }
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.raw_web_logs (value STRING) USING text "
        f"LOCATION '{root}/raw/{RAW_FOLDERS['raw_web_logs']}'"
    )
    for name, schema in texts.items():
        columns = ", ".join(f"`{c}` STRING" for c in schema.names)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING csv "
            "OPTIONS (header 'true', sep ',', quote '\"', escape '\\\\', enforceSchema 'true') "
            f"LOCATION '{root}/raw/{RAW_FOLDERS[name]}'"
        )


def orc_options(layout: Layout) -> dict[str, str]:
    """How the files of a table are written."""
    bloom = {"orc.bloom.filter.columns": ",".join(layout.bloom)} if layout.bloom else {}
    return {"orc.compress": layout.compress, **layout.orc, **bloom}


def create_processed_table(
    spark: SparkSession, name: str, database: str = PROCESSED_DB, bucketed: bool = True
) -> None:
    """``bucketed=False`` suits tables of a few gigabytes, which buckets would cut into tiny files."""
    layout = LAYOUTS[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.PROCESSED[name])
    options = orc_options(layout)
    if layout.partitions:
        # An overwrite replaces the days it holds, whatever the session says.
        options["partitionOverwriteMode"] = "dynamic"
    listed = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    ddl = f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING orc OPTIONS ({listed})"
    if layout.partitions:
        ddl += f" PARTITIONED BY ({', '.join(layout.partitions)})"
    if layout.bucket_column and bucketed:
        ddl += (f" CLUSTERED BY ({layout.bucket_column}) SORTED BY ({layout.bucket_column})"
                f" INTO {layout.buckets} BUCKETS")
    spark.sql(ddl)


def create_processed_tables(spark: SparkSession, database: str = PROCESSED_DB, bucketed: bool = True) -> None:
    for name in LAYOUTS:
        create_processed_table(spark, name, database, bucketed)


def is_bucketed(spark: SparkSession, table: str) -> bool:
    return any(c.isBucket for c in spark.catalog.listColumns(table))


def partition_clause(listed: str) -> str:
    """``dt=2024-01-15/zone=lab`` as SHOW PARTITIONS gives it, as a clause for ALTER TABLE."""
    parts = []
    for piece in listed.split("/"):
        column, _, value = piece.partition("=")
        text = unquote(value)
        literal = "null" if text == "__HIVE_DEFAULT_PARTITION__" else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        parts.append(f"`{column}` = {literal}")
    return f"PARTITION ({', '.join(parts)})"


def describe_database(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {name}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """Row count and size, and column statistics for the named columns, in one pass."""
    named = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{named}")


def analyze_all(spark: SparkSession, database: str = PROCESSED_DB) -> None:
    for name, layout in LAYOUTS.items():
        analyze(spark, f"{database}.{name}", layout.statistics)


def analyze_raw(spark: SparkSession, database: str = RAW_DB) -> None:
    """Row count and size of the tables over the landing zone."""
    for name in RAW_FOLDERS:
        analyze(spark, f"{database}.{name}")
