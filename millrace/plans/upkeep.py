"""Keeping tables in shape: small files, retention."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession, functions as F

from ..functions.measures import rows
from ..session import TARGET_FILE_BYTES
from ..sources.catalog import LAYOUTS, PROCESSED_DB, is_bucketed, partition_clause
from ..sources.sinks import staged

SMALL_FILE_BYTES = 16 * 1024 * 1024
RETENTION_DAYS = 90
DROPPED_AT_ONCE = 500


def partition_files(spark: SparkSession, table: str, spec: dict[str, str]) -> tuple[int, int]:
    """Number of files and bytes of one partition."""
    part = spark.table(table).filter(_matches(spec))
    files = part.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b")).distinct()
    found = files.agg(rows().alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")).first()
    return found["n"], found["bytes"]


def _matches(spec: dict[str, str]):
    condition = F.lit(True)
    for column, value in spec.items():
        condition = condition & (F.col(column) == value)
    return condition


def compact_partition(
    spark: SparkSession, name: str, spec: dict[str, str], database: str = PROCESSED_DB,
    target_bytes: int = TARGET_FILE_BYTES, small_bytes: int = SMALL_FILE_BYTES,
) -> bool:
    """Rewrite one partition in files of about ``target_bytes``.

    Does nothing where the files are large enough on average. The rows go
    through a staged copy, as Spark does not overwrite a table it is reading;
    should the rewrite fail, the old files are still in place.
    """
    table, layout = f"{database}.{name}", LAYOUTS[name]
    files, size = partition_files(spark, table, spec)
    wanted = max(1, math.ceil(size / target_bytes))
    if files <= wanted or size / files >= small_bytes:
        return False
    with staged(spark.table(table).filter(_matches(spec))) as copy:
        if is_bucketed(spark, table):
            bucket = F.pmod(F.hash(layout.bucket_column), F.lit(layout.buckets))
            spread = copy.repartition(max(wanted, layout.buckets), bucket)
        else:
            spread = copy.repartition(wanted)
        spread.write.insertInto(table, overwrite=True)
    return True


def drop_partitions(spark: SparkSession, table: str, listed: list[str]) -> None:
    """Drop partitions named as SHOW PARTITIONS does."""
    for at in range(0, len(listed), DROPPED_AT_ONCE):
        clauses = ", ".join(partition_clause(p) for p in listed[at:at + DROPPED_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clauses}")


def prune_partitions(
    spark: SparkSession, name: str, as_of: str, database: str = PROCESSED_DB, days: int = RETENTION_DAYS
) -> list[str]:
    """Drop the partitions older than the retention period; returns their days.

    Works on the list of partitions only, no data is read.
    """
    table = f"{database}.{name}"
    dt = F.regexp_extract("partition", r"(?:^|/)dt=(\d{4}-\d{2}-\d{2})(?:/|$)", 1)
    limit = F.date_sub(F.lit(as_of).cast("date"), days)
    old = (
        spark.sql(f"SHOW PARTITIONS {table}").withColumn("dt", dt)
        .filter((F.col("dt") != "") & (F.col("dt").try_cast("date") < limit))
        .collect()  # partition names only
    )
    drop_partitions(spark, table, [r["partition"] for r in old])
    return sorted({r["dt"] for r in old})
