"""Several tables from one pass over the source.

Each row is tagged with every table it goes to; one write lays the rows down by table
and partition, and the folders then take the place of those partitions. Nothing is
staged as rows and read again. Suits branches that keep, drop or change single rows;
a branch that groups needs ``sinks.multi_insert``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import files
from .catalog import is_bucketed, partition_clause

PARTITIONS_AT_ONCE = 500


@dataclass(frozen=True)
class Branch:
    """The rows of the source that go to ``table``; ``values`` replaces columns of the source."""

    table: str
    condition: Column | None = None
    values: dict[str, Column] = field(default_factory=dict)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def tagged(source: DataFrame, branches: Sequence[Branch]) -> DataFrame:
    """One row per row and table it goes to: ``target`` (the branch's number) and the columns of all tables.

    Columns that a table does not have are NULL in its rows and take no room in the files.
    """
    spark = source.sparkSession
    shapes = [{f.name: f.dataType for f in spark.table(b.table).schema} for b in branches]
    every = {name: kind for shape in shapes for name, kind in shape.items()}
    if any(every[name] != kind for shape in shapes for name, kind in shape.items()):
        raise ValueError("tables share a column name with different types")

    def entry(number: int, branch: Branch) -> Column:
        values = [
            (branch.values.get(n, F.col(f"`{n}`")) if n in shapes[number] else F.lit(None)).cast(kind).alias(n)
            for n, kind in every.items()
        ]
        own = F.struct(F.lit(number).alias("target"), *values)
        return own if branch.condition is None else F.when(branch.condition, own)

    entries = F.array_compact(F.array(*[entry(i, b) for i, b in enumerate(branches)]))
    return source.select(F.explode(entries).alias("row")).select("row.*")


def split_insert(source: DataFrame, branches: Sequence[Branch], **options: str) -> None:
    """Overwrite, in each table, the partitions that its branch has rows for; other partitions stay.

    All tables are ORC with the same partition columns and without buckets, on one file
    system. The write is one job; should it or the exchange of folders fail, running it
    again gives the same tables. Readers of a partition must wait for the exchange, as
    with any overwrite.
    """
    spark = source.sparkSession
    columns = _partition_columns(spark, branches[0].table)
    if not columns or any(_partition_columns(spark, b.table) != columns for b in branches):
        raise ValueError("the tables need the same partition columns")
    if len({b.table for b in branches}) < len(branches) or any(is_bucketed(spark, b.table) for b in branches):
        raise ValueError("each table once, and none with buckets")
    homes = [files.table_folder(spark, b.table) for b in branches]
    staging = f"{homes[0]}/_split-{uuid.uuid4().hex}"
    try:
        rows = tagged(source, branches).hint("rebalance", "target", *columns)
        rows.write.options(**options).partitionBy("target", *columns).orc(staging)
        folder = F.regexp_replace("name", "/[^/]*$", "")
        places = [r["folder"] for r in files.listed(spark, staging).select(folder.alias("folder")).distinct().collect()]
        attach(spark, staging, places, branches, homes)
    finally:
        files.delete(spark, staging)


def attach(spark: SparkSession, staging: str, places: Sequence[str], branches: Sequence[Branch], homes: Sequence[str]) -> None:
    """Put the written partition folders (``target=0/dt=...``) in the place of those of the tables."""
    found = [(int(number), part) for number, part in (re.fullmatch(r"target=(\d+)/(.+)", p).groups() for p in places)]

    def exchange(item: tuple[int, str]) -> None:
        number, part = item
        files.delete(spark, f"{homes[number]}/{part}")
        files.move(spark, f"{staging}/target={number}/{part}", f"{homes[number]}/{part}")

    files.side_by_side(exchange, found)
    for number, branch in enumerate(branches):
        parts = sorted(part for n, part in found if n == number)
        for at in range(0, len(parts), PARTITIONS_AT_ONCE):
            clauses = " ".join(partition_clause(p) for p in parts[at:at + PARTITIONS_AT_ONCE])
            spark.sql(f"ALTER TABLE {branch.table} ADD IF NOT EXISTS {clauses}")
        spark.catalog.refreshTable(branch.table)
