"""Snapshots of a landing folder that copy only what is new.

``<archive>/objects`` holds the bytes, ``<archive>/manifests/<source>/<day>`` one row
per piece of each file a snapshot has: name, size, time, place and SHA-256. A file
whose name, size and time are those of the snapshot before is not copied again; its
rows point to the bytes that lie there. Large files are copied in pieces, so that no
task copies one alone. The manifest is written last: a snapshot that fails leaves none
and is simply taken again. A piece gets its name only when it is complete, so a task
that is lost or runs twice does no harm.

Copies go through Arrow's file systems inside the tasks, byte for byte. A file changed
without a new size or time is not seen. Empty files are left out. Files that are gone from the folder are not in
the new manifest, and stay in the snapshots before.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import MANIFEST
from . import files

PIECE_BYTES = 256 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop path and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or path.startswith("/"):
        return fs.LocalFileSystem(), "/" + (rest if scheme == "file" else path).lstrip("/")
    return fs.FileSystem.from_uri(path)


class _Target:
    """A file that gets its name when it is complete."""

    def __init__(self, path: str):
        self.system, self.path = _opened(path)
        folder, _, name = self.path.rpartition("/")
        self.unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.system.create_dir(folder, recursive=True)

    def __enter__(self):
        self.out = self.system.open_output_stream(self.unfinished)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind:
            self.system.delete_file(self.unfinished)
        else:
            self.system.move(self.unfinished, self.path)


def _copy(source: str, start: int, length: int, out) -> str:
    """Append a range of a file to ``out``; returns its SHA-256."""
    system, path = _opened(source)
    seen, left = hashlib.sha256(), length
    with system.open_input_file(path) as data:
        data.seek(start)
        while left:
            chunk = data.read(min(left, CHUNK_BYTES))
            if not chunk:
                raise OSError(f"{source} is shorter than it was listed")
            seen.update(chunk)
            out.write(chunk)
            left -= len(chunk)
    return seen.hexdigest()


def _stored(batches: Iterator[pd.DataFrame], root: str) -> Iterator[pd.DataFrame]:
    for rows in batches:
        digests = []
        for path, start, length, stored in zip(rows["path"], rows["start"], rows["length"], rows["stored"], strict=True):
            with _Target(f"{root}/{stored}") as out:
                digests.append(_copy(path, int(start), int(length), out))
        yield rows.assign(sha256=digests)[MANIFEST.names]


def _restored(batches: Iterator[pd.DataFrame], root: str, target: str) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for name, pieces in zip(rows["name"], rows["pieces"], strict=True):
            with _Target(f"{target}/{name}") as out:
                for piece in pieces:
                    if _copy(f"{root}/{piece['stored']}", 0, piece["length"], out) != piece["sha256"]:
                        raise OSError(f"{name}: stored piece {piece['stored']} is damaged")
        yield rows[["name", "bytes"]]


def _spread(rows: DataFrame) -> DataFrame:
    """Few rows a task, as each stands for many bytes."""
    return rows.repartition(max(1, min(rows.count(), 10_000)))


def manifest(spark: SparkSession, archive_root: str, source: str, day: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{archive_root}/manifests/{source}/{day}")


def snapshots(spark: SparkSession, archive_root: str, source: str) -> list[str]:
    """The days that have a complete snapshot."""
    root = f"{archive_root}/manifests/{source}"
    return [day for day in files.children(spark, root) if files.exists(spark, f"{root}/{day}/_SUCCESS")]


def snapshot(
    spark: SparkSession, source_path: str, archive_root: str, source: str, day: str, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Take the snapshot of a day and return the manifest rows of what was copied.

    Taking it again replaces it. An empty folder gives an empty manifest.
    """
    root = files.qualified(spark, archive_root)
    before = [d for d in snapshots(spark, root, source) if d < day]
    known = manifest(spark, root, source, before[-1]) if before else spark.createDataFrame([], MANIFEST)
    present, same = files.listed(spark, source_path), ["name", "bytes", "modified"]
    kept = known.join(present.select(same), same, "left_semi")
    taken = f"{source}/{day}/{uuid.uuid4().hex}"
    last = F.greatest(F.floor((F.col("bytes") - 1) / piece_bytes), F.lit(0)).cast("int")
    new = (
        present.join(known.select(same).distinct(), same, "left_anti")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("start", F.col("piece").cast("long") * piece_bytes)
        .withColumn("length", F.least(F.lit(piece_bytes), F.col("bytes") - F.col("start")))
        .withColumn("stored", F.concat(F.lit(f"objects/{taken}/"), F.sha2("name", 256), F.lit("-"), F.col("piece")))
    )
    copied = _spread(new).mapInPandas(partial(_stored, root=root), MANIFEST)
    with_old = copied.unionByName(kept.select(MANIFEST.names))
    with_old.write.mode("overwrite").parquet(f"{root}/manifests/{source}/{day}")
    return manifest(spark, root, source, day).filter(F.startswith("stored", F.lit(f"objects/{taken}/")))


def restore(spark: SparkSession, archive_root: str, source: str, day: str, target: str) -> int:
    """Write the files of a snapshot to a folder, checked by their SHA-256; returns how many."""
    root, target = files.qualified(spark, archive_root), files.qualified(spark, target)
    pieces = F.sort_array(F.collect_list(F.struct("piece", "length", "sha256", "stored"))).alias("pieces")
    whole = manifest(spark, root, source, day).groupBy("name", "bytes").agg(pieces)
    written = _spread(whole).mapInPandas(partial(_restored, root=root, target=target), "name string, bytes long")
    return written.count()
