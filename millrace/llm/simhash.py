"""Near-duplicates by SimHash and covering locality-sensitive hashing.

Fingerprint: words are maximal runs of non-blank bytes (ASCII white space),
A-Z in lower case; each shingle of consecutive words, joined by one space, is
hashed with XXH64 (seed 42); a fingerprint bit is 1 if it is set in over half
the hashes. A text of fewer words is one shingle, a text of none has
fingerprint zero.

Links: two fingerprints link when at most ``radius`` bits differ. Give each bit
position one of 2^(radius+1) vectors over GF(2); every nonzero vector v makes a
mask of the positions whose vector has an odd inner product with v. For any
``radius`` positions some v is orthogonal to all their vectors, so its mask hides
all of them: every pair within the radius meets in a table, whatever the data.

Only distinct fingerprints enter the tables, so copies cost nothing. Buckets of
over ``BUCKET`` fingerprints are divided again by masks over the bits their table
hides; after that at most 2^16 or so fingerprints can share a key. A bucket
returns a spanning forest of its links, never its pairs. Components come from
repeated minimum and jump steps over those links.

Cases: null and blank texts have fingerprint zero and link like any other;
repeated rows stay; null ids are left out of the choice of component_id unless a
component has no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import written
from .components import components

BITS = 64
BUCKET = 2_000


def fingerprint(text: str | None, words: int = 3) -> int:
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    hashed = xxhash.xxh64_intdigest
    hashes = [hashed(b" ".join(parts[i:i + words]), 42) for i in range(max(1, len(parts) - words + 1))]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes; blocks keep the unpacked bits small."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        octets = hashes[at:at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and its fingerprint as a (signed) long."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            prints = np.array([fingerprint(t, words) for t in rows["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "fp": prints})

    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return small.mapInPandas(each, "doc_id long, fp long")


def masks(radius: int, positions: list[int] | None = None, seed: int = 7) -> list[int]:
    """The covering masks over the given bit positions (all 64 by default)."""
    positions = list(range(BITS)) if positions is None else positions
    vectors = 2 ** (radius + 1)
    # Every vector is used about equally often, in an order drawn from the seed.
    order = np.random.default_rng(seed).permutation(len(positions))
    vector_of = {positions[p]: 1 + i % (vectors - 1) for i, p in enumerate(order)}
    return [sum(1 << p for p, x in vector_of.items() if (x & v).bit_count() % 2) for v in range(1, vectors)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _bucket_links(radius: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for members in rows["fps"]:
                a, b = _forest(np.asarray(members, np.int64).view(np.uint64), radius)
                if len(a):
                    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return links


def _forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs within the radius join.

    Goes breadth first: each fingerprint is compared once with those not yet
    reached, so a bucket of one group takes few rounds and yields n - 1 links.
    """
    left = np.unique(fps)
    one, other = [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            here, front = front[0], front[1:]
            near = np.bitwise_count(left ^ here) <= radius
            if near.any():
                reached = left[near]
                one.append(np.full(len(reached), here))
                other.append(reached)
                front, left = np.concatenate([front, reached]), left[~near]
    if not one:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(one), np.concatenate(other)


def _tables(fps: DataFrame, radius: int) -> DataFrame:
    keys = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks(radius))]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.key")


def links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough to join all that are within the radius."""
    keyed = _tables(fps, radius)
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    small = keyed.join(sizes.filter(F.col("n") <= bucket), ["t", "key"], "left_semi")
    large = keyed.join(sizes.filter(F.col("n") > bucket), ["t", "key"], "left_semi")

    tables = masks(radius)
    second = []
    for t, m in enumerate(tables):
        hidden = [p for p in range(BITS) if not m >> p & 1]
        second.append(F.array(*[F.lit(_signed(x)) for x in masks(radius, hidden, seed=11 + t)]))
    inner = F.posexplode(F.element_at(F.array(*second), F.col("t") + 1)).alias("u", "mask")
    split = large.select("fp", "t", "key", inner).select("fp", "t", "key", "u", F.col("fp").bitwiseAND(F.col("mask")).alias("sub"))
    found = [
        small.groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select("fps"),
        split.groupBy("t", "key", "u", "sub").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps"),
    ]
    return found[0].unionByName(found[1]).mapInPandas(_bucket_links(radius), "a long, b long").distinct()


def linked(prints: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of all reachable documents."""
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = written(classes, "simhash-classes")
    joined = components(written(links(classes.select("fp"), radius), "simhash-links"))
    named = classes.join(joined, classes["fp"] == joined["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("__root"))
    smallest = named.groupBy("__root").agg(F.min("first_id").alias("component_id"))
    labels = named.join(smallest, "__root").select(F.col("fp").alias("__fp"), "component_id")
    return prints.join(labels, prints["fp"] == labels["__fp"]).select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = written(fingerprints(docs, words), "simhash-prints")
    return linked(prints, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def group_firsts(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component left.

    The one with the smallest doc_id stays. Rows that share an id share its
    fate; rows without an id stay.
    """
    dropped = linked(written(fingerprints(docs, words), "simhash-prints"), radius).filter("doc_id <> component_id")
    return docs.join(dropped.select(F.col("doc_id").alias("__id")).distinct(), docs["doc_id"] == F.col("__id"), "left_anti")
