"""Writers: tables, CSV folders, snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import schemas
from ..functions.measures import rows
from ..session import shared_folder
from .catalog import LAYOUTS, PROCESSED_DB, Layout, is_bucketed

MAX_PARALLEL_WRITES = 8


def _gathered(df: DataFrame, layout: Layout, bucketed: bool) -> DataFrame:
    """Bring the rows of one partition and bucket together before writing.

    ``rebalance`` joins small pieces to files of the advisory size and splits
    a day or bucket that outgrows it, so no writer gets a hot day alone.
    """
    if not layout.partitions:
        return df.hint("rebalance")
    if not bucketed:
        return df.hint("rebalance", *layout.partitions)
    bucket = F.pmod(F.hash(layout.bucket_column), F.lit(layout.buckets))
    return df.withColumn("_bucket", bucket).hint("rebalance", *layout.partitions, "_bucket").drop("_bucket")


def overwrite_table(df: DataFrame, name: str, database: str = PROCESSED_DB, max_partitions: int | None = None) -> None:
    """Write a processed table.

    A partitioned table keeps the partitions that ``df`` does not hold; an
    unpartitioned one is replaced. Running it again gives the same table.
    ``max_partitions`` stops a write that would create too many directories.
    """
    layout = LAYOUTS[name]
    if max_partitions is not None and layout.partitions:
        found = df.select(*layout.partitions).distinct().limit(max_partitions + 1).count()
        if found > max_partitions:
            raise ValueError(f"{name}: more than {max_partitions} partitions")
    table, columns = f"{database}.{name}", schemas.PROCESSED[name].names
    bucketed = is_bucketed(df.sparkSession, table)
    _gathered(df.select(*columns), layout, bucketed).write.insertInto(table, overwrite=True)


def overwrite_path(df: DataFrame, path: str, partitions: Sequence[str] = (), **options: str) -> None:
    """The same for a plain ORC folder."""
    writer = df.hint("rebalance", *partitions).write.mode("overwrite").options(**options)
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.orc(path)


@contextmanager
def staging_folder(spark: SparkSession, kind: str) -> Iterator[str]:
    """The path of a new folder in the shared one; it goes when the block ends.

    Deleting needs the Hadoop client behind a classic session; Connect has none.
    """
    folder = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """The size of all files below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Write a result once to the shared folder and go on from the files.

    The steps inside read it instead of computing it again, also after an
    executor is lost. The files go when the block ends.
    """
    with staging_folder(df.sparkSession, "staged") as folder:
        df.write.orc(folder)
        yield df.sparkSession.read.schema(df.schema).orc(folder)


def in_parallel(tasks: Sequence[Callable[[], None]]) -> None:
    """Run independent writes side by side; the first error is raised."""
    with ThreadPoolExecutor(max_workers=min(MAX_PARALLEL_WRITES, max(len(tasks), 1))) as pool:
        for done in [pool.submit(t) for t in tasks]:
            done.result()


def multi_insert(
    source: DataFrame, branches: Sequence[tuple[Callable[[DataFrame], DataFrame], str]],
    database: str = PROCESSED_DB, stage: bool = True,
) -> None:
    """Feed several tables from one source that is computed once.

    ``stage=False`` suits a source that is a stored table already: each branch
    then reads only the columns it needs.
    """
    with staged(source) if stage else nullcontext(source) as shared:
        in_parallel(
            [lambda plan=plan, name=name: overwrite_table(plan(shared), name, database) for plan, name in branches]
        )


# Doubled quotes as in RFC 4180, and blanks at the ends of a value kept.
CSV_VALUES = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def delimited_folder(df: DataFrame, path: str) -> None:
    """Comma-separated rows, no header, no compression."""
    df.write.mode("overwrite").options(**CSV_VALUES).option("compression", "none").csv(path)


def csv_export(
    df: DataFrame, path: str, sep: str = ",", quote_all: bool = False, single_file: bool = False
) -> int:
    """CSV (or TSV) folder with header lines; returns the number of rows.

    A sorted result stays sorted over its part files. ``single_file`` writes
    one file through one task: only for results of a fixed size, such as a
    top-k report.
    """
    seen = Observation()
    counted = df.observe(seen, rows().alias("n"))
    out = counted.coalesce(1) if single_file else counted
    writer = out.write.mode("overwrite").options(**CSV_VALUES)
    writer.option("header", True).option("sep", sep).option("quoteAll", quote_all).csv(path)
    return seen.get["n"]


def archive_snapshot(spark: SparkSession, source_path: str, archive_root: str, day: str, source: str) -> str:
    """Copy the lines of a landing folder to ``<archive>/<day>/<source>``."""
    target = f"{archive_root}/{day}/{source}"
    spark.read.text(source_path).write.mode("overwrite").option("compression", "gzip").text(target)
    return target
