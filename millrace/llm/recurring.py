"""Which documents share content, by sampled n-grams (winnowing).

Of each window of L tokens the n-gram with the smallest hash is an anchor. Equal
windows have equal anchors, so a window that stands in two documents has an anchor
that stands in both: looking at windows whose anchor recurs loses none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import text_or_empty

TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * _A
        h = (h ^ (h >> np.uint64(33))) * _B
        return h ^ (h >> np.uint64(33))


def gram_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` tokens, doubled up from shorter runs."""
    if len(tokens) < size:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        have, runs, done, start = mixed(tokens.astype(np.uint64) + np.uint64(1)), None, 0, 1
        left = size
        while left:
            if left & 1:
                part = have[done:]
                runs = part.copy() if runs is None else mixed(runs[:len(part)] * _B + part[:len(runs)])
                done += start
            left >>= 1
            if left:
                have = mixed(have[:-start] * _A + have[start:])
                start *= 2
        return runs[:len(tokens) - size + 1]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have, span = values, 1
    while span * 2 <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[:len(have) - rest], have[rest:]) if rest else have


def anchor_mask(hashes: np.ndarray, width: int) -> np.ndarray:
    """Which n-grams are the smallest of some window of ``width`` n-grams."""
    if len(hashes) < width:
        return np.zeros(len(hashes), bool)
    low = sliding_min(hashes, width)
    pad = np.zeros(width - 1, np.uint64)
    highest = ~sliding_min(~np.concatenate([pad, low, pad]), width)
    return hashes == highest[:len(hashes)]


def chunks(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows of about ``most`` in all."""
    run = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield slice(a, b)


def with_ids(docs: DataFrame) -> tuple[DataFrame, int]:
    """(id, text) with unique ids that sort as doc_id does, and how many ids share a doc_id at most.

    ``id // shared`` is the order of documents: rows that share a doc_id, or have
    none, are equals, and rows without one come last.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    per_id = base.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    shared, highest, without = per_id.agg(F.max("n"), F.max("doc_id"), F.max(F.col("doc_id").isNull())).first()
    if shared in (None, 1) and not without:
        return base.select(F.coalesce("doc_id", F.lit(0)).alias("id"), "text"), 1
    known = F.coalesce("doc_id", F.lit((highest or 0) + 1))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) - 1
    return base.select(F.coalesce(known * F.lit(shared) + number, F.lit(0)).cast("long").alias("id"), "text"), shared


def recurring(rows: DataFrame, anchors: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int) -> DataFrame:
    """id and hs, the anchors of a document that other documents have as well.

    ``anchors`` gives hashes and row numbers for a list of texts. Within a batch, an
    anchor of several documents is known to recur: one row stands for it, so a
    passage of a third of all documents sends a row per batch.
    """
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for part in chunks(whole["text"].str.len().to_numpy(), most):
                batch = whole.iloc[part]
                h, row = anchors(batch["text"].tolist())
                h, row = _distinct(h, row)
                ids = batch["id"].to_numpy()
                first = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
                group = np.cumsum(first) - 1
                many = (np.bincount(group) > 1)[group] if len(h) else np.zeros(0, bool)
                alone, known, heads = ~many, many, many & first
                with np.errstate(over="ignore"):
                    apart = mixed(h[known] + ids[row[known]].astype(np.uint64) * _A)
                yield pd.DataFrame({
                    "key": np.concatenate([h[alone], h[heads], apart]).view(np.int64),
                    "id": pd.arrays.IntegerArray(
                        np.concatenate([ids[row[alone]], np.zeros(heads.sum(), np.int64), ids[row[known]]]),
                        np.concatenate([np.zeros(alone.sum(), bool), np.ones(heads.sum(), bool), np.zeros(known.sum(), bool)])),
                    "h": pd.arrays.IntegerArray(
                        np.concatenate([np.zeros(alone.sum() + heads.sum(), np.int64), h[known].view(np.int64)]),
                        np.concatenate([np.ones(alone.sum() + heads.sum(), bool), np.zeros(known.sum(), bool)])),
                })

    sent = rows.mapInPandas(each, "key long, id long, h long")
    counted = sent.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    found = counted.filter("id is not null and (h is not null or n > 1)")
    return found.groupBy("id").agg(F.collect_list(F.coalesce("h", "key")).alias("hs"))


def _distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, by hash and row."""
    order = np.lexsort((row, h))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, bool)
    return h[new], row[new]


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - edges[::2]


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places the spans cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + lengths, size), -1)
    return np.cumsum(change)[:size] > 0
