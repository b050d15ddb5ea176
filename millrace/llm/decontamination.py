"""Passages of benchmark items inside documents.

Every item of n words is compared with the n-word windows of a document. Item and
window become weighted SimHash fingerprints of their five-word shingles; blocks of
the fingerprint (multi-index Hamming search) return every item of that size within
``radius`` bits, and the weighted Jaccard similarity of the shingles decides.
A shingle weighs ln((1 + items) / (1 + items that have it)) + 1, so a phrase that
many items share proves little.

A window that shares no shingle with an item has similarity zero, so only windows
around shared shingles are formed; no other window could pass. A document with
fewer words than the item is one window, compared with every item it shares a
shingle with.

The items are a stated query set: they go to the tasks in blocks of ``ITEMS``,
and every document meets every block.

Words are runs of letters, digits and underscores in lower case, so case, white
space and punctuation do not hide a passage. Items of fewer than five words are
one shingle. Cases: null, empty and wordless items match nothing; null and empty
texts contain nothing; repeated documents and repeated items each give their row;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import partitions_for

SHINGLE = 5
ITEMS = 10_000
RADIUS = 20
SIMILAR = 0.8
BLOCKS = 8
_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHARS_AT_ONCE = 4_000_000
MATCHES = "doc_id long, item_id long, similarity double, first_word int, n_words int"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(words: list[str]) -> list[str]:
    size = min(SHINGLE, len(words))
    return [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if words else []


def similarity(a: Counter, b: Counter, weight) -> float:
    both = sum(weight(s) * min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(weight(s) * n for s, n in a.items()) + sum(weight(s) * n for s, n in b.items()) - both
    return both / total if total else 0.0


def _bits(names: list[str], weights: np.ndarray) -> np.ndarray:
    """A row of +w or -w per shingle and bit."""
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in names], np.uint64)
    signs = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) * 2 - 1
    return signs * weights[:, None]


class HammingBlocks:
    """All fingerprints within a radius of a query.

    Two fingerprints within ``radius`` bits differ in at most ``radius // blocks``
    bits of some block, so looking up each block with that tolerance finds them all.
    """

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        values = np.arange(256, dtype=np.uint8)
        own = prints.view(np.uint8).reshape(-1, BLOCKS)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius // BLOCKS
        self.lists = [[np.flatnonzero(near[v][own[:, b]]) for v in range(256)] for b in range(BLOCKS)]

    def search(self, query: np.uint64) -> np.ndarray:
        octets = np.array([query], np.uint64).view(np.uint8)
        found = np.unique(np.concatenate([self.lists[b][v] for b, v in enumerate(octets)]))
        return found[np.bitwise_count(self.prints[found] ^ query) <= self.radius]


@dataclass
class _Items:
    """A block of items, ready to search with."""

    ids: list
    counts: list[Counter]
    sizes: list[int]
    weights: dict[str, float]
    rare: float
    radius: int

    def __post_init__(self):
        self.vocabulary: dict[str, int] = {}
        self.by_hash: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        by_size = defaultdict(list)
        prints = np.zeros(len(self.ids), np.uint64)
        for i, counts in enumerate(self.counts):
            names = list(counts.elements())
            prints[i] = self.packed(_bits(names, self.weigh(names)).sum(axis=0)[None, :])[0]
            by_size[self.sizes[i]].append(i)
            for name in counts:
                code = 0
                for word in name.split(" "):
                    code = (code * int(_STEP) + self.vocabulary.setdefault(word, len(self.vocabulary) + 1)) % 2**64
                self.by_hash[min(SHINGLE, self.sizes[i])][code].append(i)
        self.by_size = {n: (np.array(at), HammingBlocks(prints[at], self.radius)) for n, at in by_size.items()}
        self.codes = {size: np.sort(np.array(list(codes), np.uint64)) for size, codes in self.by_hash.items()}

    def weigh(self, names: list[str]) -> np.ndarray:
        return np.array([self.weights.get(s, self.rare) for s in names])

    @staticmethod
    def packed(sums: np.ndarray) -> np.ndarray:
        return np.packbits(sums > 0, axis=1).view(np.uint64).reshape(-1)

    def matches(self, texts: list[str | None], least: float) -> list[tuple[int, int, float, int]]:
        """(document, item, similarity, first word) of the best window for each pair."""
        split = [words_of(t) for t in texts]
        gap = [0] * SHINGLE
        get = self.vocabulary.get
        flat = np.fromiter((x for words in split for x in (*(get(w, 0) for w in words), *gap)), np.uint64)
        starts = np.concatenate([[0], np.cumsum([len(w) + SHINGLE for w in split])])
        hits: dict[tuple[int, int], list[int]] = defaultdict(list)
        for size, codes in self.codes.items():
            n = len(flat) - size + 1
            if n <= 0:
                continue
            code, known = np.zeros(n, np.uint64), np.ones(n, bool)
            with np.errstate(over="ignore"):
                for k in range(size):
                    code = code * _STEP + flat[k:n + k]
                    known &= flat[k:n + k] > 0
            place = np.flatnonzero(known)
            at = np.searchsorted(codes, code[place])
            place = place[codes[np.minimum(at, len(codes) - 1)] == code[place]]
            for p in place:
                doc = int(np.searchsorted(starts, p, "right")) - 1
                for item in self.by_hash[size][int(code[p])]:
                    hits[doc, item].append(int(p - starts[doc]))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        done: set[tuple[int, int, int]] = set()
        for (doc, item), places in hits.items():
            n = self.sizes[item]
            size = min(SHINGLE, n)
            if len(split[doc]) < n:
                value = similarity(Counter(shingles(split[doc])), self.counts[item], lambda x: self.weights.get(x, self.rare))
                if value >= least:
                    best[doc, item] = (value, 0)
                continue
            runs, first = [], None
            for p in sorted(places):
                low, high = max(0, p - n + size), min(p, len(split[doc]) - n)
                if high < low:
                    continue
                if first is not None and low <= runs[-1][1] + 1:
                    runs[-1][1] = max(high, runs[-1][1])
                else:
                    runs.append([low, high])
                first = p
            for low, high in runs:
                self._windows(doc, split[doc], n, size, low, high, least, best, done)
        return [(d, i, s, w) for (d, i), (s, w) in sorted(best.items())]

    def _windows(self, doc, words, n, size, low, high, least, best, done) -> None:
        """Windows of n words that start at low..high against all items of n words."""
        starts = [s for s in range(low, high + 1) if (doc, n, s) not in done]
        if not starts:
            return
        done.update((doc, n, s) for s in starts)
        names = [" ".join(words[i:i + size]) for i in range(low, high + n - size + 1)]
        sums = np.concatenate([np.zeros((1, 64)), np.cumsum(_bits(names, self.weigh(names)), axis=0)])
        per = n - size + 1
        at = np.array(starts) - low
        prints = self.packed(np.round(sums[at + per] - sums[at], 9))
        items, index = self.by_size[n]
        for s, fp in zip(starts, prints, strict=True):
            near = index.search(fp)
            if not len(near):
                continue
            own = Counter(names[s - low:s - low + per])
            for item in items[near]:
                value = similarity(own, self.counts[item], lambda x: self.weights.get(x, self.rare))
                if value >= least and value > best.get((doc, int(item)), (0.0, 0))[0]:
                    best[doc, int(item)] = (value, s)


def _item_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        split = [words_of(t) for t in rows["text"]]
        yield pd.DataFrame({"item_id": rows["item_id"], "block": rows["block"], "n_words": [len(w) for w in split], "names": [shingles(w) for w in split]})


def _blocks(benchmark: DataFrame, radius: int, items_at_once: int) -> Iterator:
    """The items in blocks of about ``items_at_once``, each sent to the executors."""
    spark = benchmark.sparkSession
    total = benchmark.count()
    blocks = partitions_for(total, items_at_once)
    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    split = source.mapInPandas(_item_shingles, "item_id long, block int, n_words int, names array<string>").filter("n_words > 0")
    having = split.select(F.explode(F.array_distinct("names")).alias("name"), "item_id").groupBy("name").agg(F.count(F.lit(1)).alias("df"))
    weighed = split.select("block", F.explode(F.array_distinct("names")).alias("name")).distinct().join(having, "name")
    for block in range(blocks):
        rows = split.filter(F.col("block") == block).collect()  # one block of the stated query set
        weights = {r["name"]: float(np.log((1 + total) / (1 + r["df"])) + 1) for r in weighed.filter(F.col("block") == block).collect()}
        yield spark.sparkContext.broadcast((
            [r["item_id"] for r in rows], [Counter(r["names"]) for r in rows], [r["n_words"] for r in rows], weights, float(np.log(1 + total) + 1), radius))


def matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILAR, items_at_once: int = ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: the best window of each document and item that match."""
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = [small.mapInPandas(_searcher(items, least), MATCHES) for items in _blocks(benchmark, radius, items_at_once)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def without_matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILAR, items_at_once: int = ITEMS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found."""
    for items in _blocks(benchmark, radius, items_at_once):
        docs = docs.filter(~_found(items, least)(F.col("text").cast("string")))
    return docs


def _groups(texts: pd.Series) -> Iterator[pd.Series]:
    """Runs of rows with a few million characters each."""
    run = texts.str.len().fillna(0).cumsum() // _CHARS_AT_ONCE
    for _, part in texts.groupby(run.to_numpy()):
        yield part


def _found(shared, least: float):
    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = _Items(*shared.value)
        for texts in batches:
            hit, at = np.zeros(len(texts), bool), 0
            for part in _groups(texts):
                for d, *_ in items.matches(part.tolist(), least):
                    hit[at + d] = True
                at += len(part)
            yield pd.Series(hit)

    return found


def _searcher(shared, least: float):
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = _Items(*shared.value)
        for batch in batches:
            for part in _groups(batch["text"]):
                found = items.matches(part.tolist(), least)
                ids = batch["doc_id"].loc[part.index].tolist()
                yield pd.DataFrame({
                    "doc_id": pd.array([ids[d] if pd.notna(ids[d]) else None for d, *_ in found], "Int64"),
                    "item_id": pd.array([items.ids[i] for _, i, *_ in found], "Int64"),
                    "similarity": np.array([s for _, _, s, _ in found], float), "first_word": np.array([w for *_, w in found], np.int32),
                    "n_words": np.array([min(items.sizes[i], len(words_of(part.iloc[d]))) for d, i, *_ in found], np.int32),
                })

    return each
