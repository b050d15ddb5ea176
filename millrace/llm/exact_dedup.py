"""Exact duplicates through a partitioned cuckoo-filter index.

Digests (SHA-256 of the text with each run of ASCII white space replaced by one
space) are dealt to partitions of the index by their leading bits. Each task
first folds its own rows of a digest into one, so a text that fills a third of
the table reaches its partition as one row per task. The partition's index
answers from fingerprints; every hit is verified against the stored digest.

``build``, ``insert``, ``delete`` and ``lookup`` keep an index as a table of
(part, state); ``deduplicated`` runs a whole table through a new one.

Cases: null and blank texts are ordinary texts ("" and " "). The row that stays
has the smallest doc_id; null ids come last. Rows repeated with the same doc_id
are duplicates too: one of them stays. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE, partitions_for, text_or_empty
from .cuckoo import CuckooIndex

KEYS_PER_PART = 500_000
NO_ID = np.iinfo(np.int64).max
_FOLDED = "digest binary, first_id long, copies long"


def text_digest() -> Column:
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(), SPACE, " "), 256))


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each digest of a batch."""
    for rows in batches:
        grouped = rows.groupby("digest", sort=False)
        yield grouped.agg(first_id=("first_id", "min"), copies=("copies", "sum")).reset_index()


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int")


def _folded(docs: DataFrame, parts: int) -> DataFrame:
    rows = docs.select(
        text_digest().alias("digest"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("first_id"), F.lit(1).cast("long").alias("copies"))
    return rows.mapInPandas(_fold, _FOLDED).withColumn("part", _part(parts))


def _add_all(index: CuckooIndex, rows: pd.DataFrame, copies: dict[int, int]) -> None:
    """Send rows through the index, smallest id first; copies counts by the id that stays."""
    ordered = rows.sort_values("first_id", kind="stable")
    words = CuckooIndex.words(list(ordered["digest"])) if len(ordered) else np.zeros((0, 4), np.uint64)
    firsts, counts = ordered["first_id"].to_numpy(), ordered["copies"].to_numpy()
    hits = index.find(words)
    for i in range(len(words)):
        # A place found before may have moved or been filled since: add() looks again on a miss.
        at = int(hits[i])
        if at < 0 or at // 4 >= index.size or not (index.digests[at // 4, at % 4] == words[i]).all():
            at = index.add(words[i], int(firsts[i]))
        if firsts[i] < index.value(at):
            index.set_value(at, int(firsts[i]))
        key = words[i].tobytes()
        copies[key] = copies.get(key, 0) + int(counts[i])


def _index_part(rows: pd.DataFrame) -> pd.DataFrame:
    index, copies = CuckooIndex(len(rows)), {}
    _add_all(index, rows, copies)
    digests, values = index.entries()
    keys = [d.tobytes() for d in digests]
    return pd.DataFrame({"digest": keys, "keep_id": values, "group_size": [copies[k] for k in keys]})


def groups(docs: DataFrame, keys_per_part: int = KEYS_PER_PART) -> DataFrame:
    """digest, keep_id, group_size of every distinct text."""
    parts = partitions_for(docs.count(), keys_per_part, docs.sparkSession.sparkContext.defaultParallelism)
    folded = _folded(docs, parts)
    return folded.groupBy("part").applyInPandas(_index_part, "digest binary, keep_id long, group_size long")


def deduplicated(docs: DataFrame, keys_per_part: int = KEYS_PER_PART) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = groups(docs, keys_per_part)
    rows = docs.select("doc_id", text_digest().alias("__digest"))
    same_id = Window.partitionBy("doc_id", "__digest").orderBy(F.lit(1))
    numbered = rows.withColumn("__copy", F.row_number().over(same_id))
    joined = numbered.join(found, F.col("__digest") == F.col("digest"))
    keep = F.nullif(F.col("keep_id"), F.lit(NO_ID))
    return joined.select(
        "doc_id", keep.alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(keep) & (F.col("__copy") == 1)).alias("kept"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )


def first_copies(docs: DataFrame, keys_per_part: int = KEYS_PER_PART) -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    decided = deduplicated(docs, keys_per_part)
    by_row = decided.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__rows"))
    named = by_row.withColumnsRenamed({"doc_id": "__id", "text_sha256": "__sha"})
    rows = docs.withColumn("__digest", F.lower(F.hex(text_digest())))
    here = rows["doc_id"].eqNullSafe(F.col("__id")) & (rows["__digest"] == F.col("__sha"))
    kept = rows.join(named.filter(~F.col("__kept")), here, "left_anti")
    # Rows repeated with one id are rare, and only they are compared as whole rows.
    repeated = named.filter("__kept and __rows > 1")
    once = kept.join(repeated, here, "left_anti")
    again = kept.join(repeated, here, "left_semi").dropDuplicates(["doc_id", "__digest"])
    return once.unionByName(again).drop("__digest")


_STATE = "part int, state binary"


def build(docs: DataFrame, parts: int) -> DataFrame:
    """A new index of (part, state); a part without texts has no row."""
    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        index = CuckooIndex(len(rows))
        _add_all(index, rows, {})
        return pd.DataFrame({"part": [key[0]], "state": [index.to_bytes()]})

    return _folded(docs, parts).groupBy("part").applyInPandas(one, _STATE)


def _restored(state: pd.DataFrame) -> CuckooIndex:
    return CuckooIndex.from_bytes(state["state"].iloc[0]) if len(state) else CuckooIndex()


def insert(index: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """The index with the texts of ``docs`` live as well."""
    def one(key: tuple, state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = _restored(state)
        _add_all(found, rows, {})
        return pd.DataFrame({"part": [key[0]], "state": [found.to_bytes()]})

    return index.groupBy("part").cogroup(_folded(docs, parts).groupBy("part")).applyInPandas(one, _STATE)


def delete(index: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """The index without the texts of ``docs``."""
    def one(key: tuple, state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = _restored(state)
        if len(rows):
            found.delete(CuckooIndex.words(list(rows["digest"])))
        return pd.DataFrame({"part": [key[0]], "state": [found.to_bytes()]})

    return index.groupBy("part").cogroup(_folded(docs, parts).groupBy("part")).applyInPandas(one, _STATE)


def lookup(index: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """digest and keep_id of those texts of ``docs`` that are live."""
    def one(key: tuple, state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = _restored(state)
        at = found.find(CuckooIndex.words(list(rows["digest"]))) if len(rows) else np.zeros(0, np.int64)
        hit = at >= 0
        return pd.DataFrame({"digest": list(rows["digest"][hit]), "keep_id": [found.value(int(a)) for a in at[hit]]})

    folded = _folded(docs, parts)
    return index.groupBy("part").cogroup(folded.groupBy("part")).applyInPandas(one, "digest binary, keep_id long").distinct()
