"""Small files of a whole table joined to large ones.

The plan comes from a listing alone. Small files of a partition folder (and bucket)
are packed by running size into groups of the target size; large files, and small ones
without company, stay as they are. Only files of groups are read, a bounded number at
a time.

The new files lie in a hidden folder of the table until a journal of the exchange is
written. A run that breaks off before leaves the table as it was; one that breaks off
after is carried on by the next run, so no row is lost or doubled. Queries on the
table must wait for the exchange, as with any overwrite.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..session import TARGET_FILE_BYTES
from ..sources import files
from ..sources.catalog import LAYOUTS, PROCESSED_DB, orc_options
from ..sources.sinks import staging_folder
from .upkeep import SMALL_FILE_BYTES

WORK = "_compaction"
FILES_AT_ONCE = 10_000
EXCHANGE = "old array<string>, new string, target string"


@dataclass(frozen=True)
class Compacted:
    """What a run did."""

    groups: int
    files_before: int
    files_after: int


def plan_compaction(
    spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES, small_bytes: int = SMALL_FILE_BYTES
) -> DataFrame:
    """The files to join: path, uri, folder, bucket (empty without buckets), bytes, bin.

    Files of one folder, bucket and bin become one file. All bins of a folder and
    bucket but the last hold at least ``target_bytes`` less one small file.
    """
    found = files.listed(spark, files.table_folder(spark, table))
    small = found.filter(F.col("bytes") < small_bytes).select(
        "path", "uri", F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.regexp_extract("path", r"_(\d+)(?:\.[^/]*)?$", 1).alias("bucket"), "bytes",
    )
    before = Window.partitionBy("folder", "bucket").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    packed = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes))
    company = F.count(F.lit(1)).over(Window.partitionBy("folder", "bucket", "bin"))
    return packed.withColumn("company", company).filter("company > 1").drop("company")


def compact_table(
    spark: SparkSession, name: str, database: str = PROCESSED_DB, target_bytes: int = TARGET_FILE_BYTES,
    small_bytes: int = SMALL_FILE_BYTES, files_at_once: int = FILES_AT_ONCE,
) -> Compacted:
    """Join the small files of a processed table; a second run finds nothing to do.

    Partitions whose folder lies outside the table's are left alone.
    """
    table = f"{database}.{name}"
    home = files.table_folder(spark, table)
    finish_exchanges(spark, table)
    groups = before = after = 0
    with staging_folder(spark, "compaction-plan") as place:
        plan_compaction(spark, table, target_bytes, small_bytes).write.parquet(place)
        plan = spark.read.parquet(place)
        rounds = -(-plan.count() // files_at_once)
        share = F.pmod(F.xxhash64("folder", "bucket", "bin"), F.lit(rounds))
        for number in range(rounds):
            rows = plan.filter(share == number).collect()  # about files_at_once names
            made = _joined(spark, name, table, home, rows) if rows else []
            groups, before, after = groups + len(made), before + len(rows), after + sum(m["new"] is not None for m in made)
    return Compacted(groups, before, after)


def _joined(spark: SparkSession, name: str, table: str, home: str, rows: list[Row]) -> list[dict]:
    """Join the files of one round and exchange them."""
    layout, work = LAYOUTS[name], f"{home}/{WORK}/{uuid.uuid4().hex}"
    numbers: dict[tuple, int] = {}
    for r in rows:
        numbers.setdefault((r["folder"], r["bucket"], r["bin"]), len(numbers))
    of_file = spark.createDataFrame(
        [(r["uri"], numbers[r["folder"], r["bucket"], r["bin"]]) for r in rows], "_uri string, _group int")
    stored = StructType([f for f in schemas.PROCESSED[name] if f.name not in layout.partitions])
    content = spark.read.schema(stored).option("recursiveFileLookup", True).orc([r["path"] for r in rows])
    grouped = (
        content.withColumn("_uri", F.col("_metadata.file_path")).join(F.broadcast(of_file), "_uri").drop("_uri")
        .repartition(len(numbers), "_group")
        .sortWithinPartitions("_group", *([layout.bucket_column] if layout.bucket_column else []))
    )
    grouped.write.options(**orc_options(layout)).partitionBy("_group").orc(f"{work}/files")
    written = {int(re.search(r"_group=(\d+)/", r["path"])[1]): r["path"] for r in files.listed(spark, f"{work}/files").collect()}
    made = [
        {
            "old": [],
            "new": written.get(number),
            "target": f"{folder}/joined-{uuid.uuid4().hex}{'_' + bucket if bucket else ''}.c000.orc",
        }
        for (folder, bucket, _), number in numbers.items()
    ]
    for r in rows:
        made[numbers[r["folder"], r["bucket"], r["bin"]]]["old"].append(r["path"])
    spark.createDataFrame(made, EXCHANGE).coalesce(1).write.parquet(f"{work}/journal")
    finish_exchanges(spark, table)
    return made


def finish_exchanges(spark: SparkSession, table: str) -> None:
    """Carry out what journals say and drop work without a journal; each step may be repeated."""
    home = files.table_folder(spark, table)

    def exchange(r: Row) -> None:
        for path in r["old"]:
            files.delete(spark, path)
        if r["new"] is not None:
            files.move(spark, r["new"], r["target"])

    for name in files.children(spark, f"{home}/{WORK}"):
        journal = f"{home}/{WORK}/{name}/journal"
        if files.exists(spark, f"{journal}/_SUCCESS"):
            files.side_by_side(exchange, spark.read.schema(EXCHANGE).parquet(journal).collect())
    files.delete(spark, f"{home}/{WORK}")
    spark.catalog.refreshTable(table)
