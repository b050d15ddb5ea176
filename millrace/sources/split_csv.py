"""Quoted CSV with line breaks inside fields, read in many tasks per file.

Spark's multi-line reader gives a file to one task, as no byte tells whether it stands inside quotes. Two
scans of the lines settle that. The first counts the quotes of each block of a file (the part one task
reads); a running parity over a file's blocks says whether a block begins inside quotes. In the second each
task cuts its blocks into records at line ends outside quotes. A record that crosses into another block
leaves a fragment on either side; these, two per block at most, are joined afterwards.

Quotes enclose fields or stand doubled inside them (RFC 4180); records end with LF or CR LF. Files with
other escapes, or with quotes inside unquoted fields, need ``csv_text(multi_line=True)``.

Both scans must cut files alike. A block the first one did not see is an error, not a guess: where the
number of executors changes between them, set ``spark.sql.files.minPartitionNum``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_CUT = "file string, block long, kind int, first boolean, text string"
WHOLE, HEAD, TAIL = 0, 1, 2


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file and block (its first byte) of each line; a CR before the LF is kept."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def block_states(read: DataFrame) -> DataFrame:
    """file, block, inside: whether the block begins inside quotes."""
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    blocks = read.groupBy("file", "block").agg((F.sum(odd) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Cutter:
    """Cuts the lines of blocks, as they come, into records and fragments."""

    def __init__(self) -> None:
        self.at, self.inside, self.open, self.begun, self.out = None, False, [], False, []

    def add(self, file: str, block: int, inside: bool, values: list[str], quotes: np.ndarray) -> None:
        if (file, block) != self.at:
            self.finish()
            # begun: the open lines began in this block. first: no record of the file has come yet.
            self.at, self.inside, self.begun, self.first = (file, block), inside, not inside, block == 0
        after = (int(self.inside) + np.cumsum(quotes)) % 2
        ends = np.flatnonzero(after == 0)
        start = 0
        for end in ends:
            if self.open or start < end:
                self.open.extend(values[start:end + 1])
                text, self.open = "\n".join(self.open), []
            else:
                text = values[start]
            self._put(WHOLE if self.begun else HEAD, text)
            self.begun, start = True, end + 1
        self.open.extend(values[start:])
        self.inside = bool(after[-1]) if len(after) else self.inside

    def _put(self, kind: int, text: str) -> None:
        if self.first:
            text = text.removeprefix("\ufeff")
        if kind == WHOLE and text in ("", "\r"):
            return
        self.out.append((*self.at, kind, self.first, text))
        self.first = False

    def finish(self) -> None:
        """The block is over: what is still open goes on in the next one."""
        if self.open:
            self._put(TAIL if self.begun else HEAD, "\n".join(self.open))
        self.open = []

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) if self.out else [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "kind", "first", "text"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = _Cutter()
    for batch in batches:
        value, file, block, inside = batch.columns
        if inside.null_count:
            raise ValueError("the two scans cut the files differently; set spark.sql.files.minPartitionNum")
        quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) % 2
        runs = pc.run_end_encode(block).run_ends.to_pylist() if len(block) else []
        start, names, values = 0, file.to_pylist(), value.to_pylist()
        for end in runs:
            # Blocks of two files may begin at the same byte.
            while start < end:
                stop = start + 1
                if names[end - 1] == names[start]:
                    stop = end
                while stop < end and names[stop] == names[start]:
                    stop += 1
                cutter.add(names[start], block[start].as_py(), inside[start].as_py(), values[start:stop], quotes[start:stop])
                start = stop
        yield cutter.taken()
    cutter.finish()
    yield cutter.taken()


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, first (of its file) and text of each record; blank lines are none."""
    read = lines(spark, path)
    # Broadcast: one row per block of a file, 800,000 for 100 TB in blocks of 128 MB.
    placed = read.join(F.broadcast(block_states(read)), ["file", "block"], "left").select("value", "file", "block", "inside")
    cut = placed.mapInArrow(_cut, _CUT)
    parts = cut.filter(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    joined = parts.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order)).groupBy("file", "record").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "kind", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    found = cut.filter(F.col("kind") == WHOLE).select("file", "first", "text").unionByName(joined.select("file", "first", text.alias("text")))
    # Where records end with CR LF, the reader of whole files gives LF inside quotes too.
    plain = F.replace(F.substring("text", F.lit(1), F.length("text") - 1), F.lit("\r\n"), F.lit("\n"))
    return found.withColumn("text", F.when(F.endswith("text", F.lit("\r")), plain).otherwise(F.col("text")))


def fields(text: Column, schema: str, **options: str) -> Column:
    """A record's columns, as the CSV reader would give them."""
    return F.from_csv(text, schema, {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", **options})
