"""Files of folders and tables: listed by Spark, moved and deleted by name.

Listing opens no file. Moves and deletions only change names, so the driver does
them, side by side; no content passes it. They need the Hadoop client behind a
classic session; Connect has none.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

AT_ONCE = 32


def _at(spark: SparkSession, path: str):
    """The path as Hadoop has it, and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(found), system


def qualified(spark: SparkSession, path: str) -> str:
    return _at(spark, path)[0].toString()


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _at(spark, path)
    return system.exists(found)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    found, system = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def delete(spark: SparkSession, path: str) -> None:
    found, system = _at(spark, path)
    system.delete(found, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; done already where only the target exists."""
    (old, system), (new, _) = _at(spark, source), _at(spark, target)
    if not system.exists(old) and system.exists(new):
        return
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def side_by_side(task, items: Sequence) -> None:
    """Call ``task`` for every item; the first error is raised."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(task, items))


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path, uri (as ``_metadata.file_path``), name (below the folder), bytes, modified; hidden and empty files are left out."""
    root = qualified(spark, folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(
        "path", F.col("_metadata.file_path").alias("uri"), F.substring("path", len(root) + 2, 2**30).alias("name"),
        F.col("length").alias("bytes"), F.unix_micros("modificationTime").alias("modified"),
    )


def table_folder(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")
