"""Near copies: documents whose five-word shingles have a Jaccard similarity of 0.8 or more.

Words are those of ``simhash``; a text of fewer words is one shingle. Documents with
equal shingle sets fold into one node, named by a 64-bit hash. Every pair below is
compared by the exact Jaccard similarity of its shingles, so no document goes for a
likeness of hashes.

1. SimHash: fingerprints and links are those of ``simhash`` (``op6``): every pair of
   fingerprints within its radius of 3 bits meets, and a forest of links joins them.
2. The pairs beyond that radius: those of 0.8 lie up to about twenty bits apart, and no
   covering of so many bits is small. ``BANDS`` keys of ``ROWS`` minimum hashes each
   find them: a pair of similarity s shares a key with probability 1 - (1 - s^5)^32,
   0.999997 at 0.8, more above. The nodes of a key are compared with the smallest of
   them where SimHash has not joined the two, so a large group of near copies costs one
   comparison per node and key, not its pairs.
3. Nodes of keys whose nodes are still in different components, such as documents around
   one long common passage, go through an exact prefix filter: with shingles ordered from
   rare to frequent, two sets of similarity 0.8 share one among the first fifth (and one
   more) of each. Passages that many documents have come last in this order and form no
   pairs. This filter is for nodes of different families: a component's family is the
   largest component it meets in a key, and its centre the node that meets most there.
4. A family may be many copies of one text, each changed so much that most are not similar
   to one another; what the text has in common would then make pairs of them all. Inside a
   family each set stands for what it changes, its symmetric difference from the centre. Nodes
   similar to the centre link with it. With r = (1 - 0.8) / (1 + 0.8), sets a and b are similar
   when they differ in at most r (|a| + |b|) shingles, so their changes A and B share at least
   (|A| + |B| - r (|a| + |b|)) / 2. If that is 0 or less, both are similar to the centre, as
   |A| >= ||a| - |centre||; else the same order from rare to frequent finds a common change.

Cases: null and blank texts have no shingle and are alike; rows that share an id
share its fate; rows without an id stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from . import simhash
from .common import written
from .components import components

WORDS = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 5
_AT_ONCE = 1024
_drawn = np.random.default_rng(42)
_FACTORS = _drawn.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _drawn.integers(0, 2**63, BANDS * ROWS, np.uint64)


def shingles(text: str | None) -> set[bytes]:
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {b" ".join(parts[i:i + WORDS]) for i in range(max(1, len(parts) - WORDS + 1))} if parts else set()


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def _hashes(own: set[bytes]) -> np.ndarray:
    return np.sort(np.array([xxhash.xxh64_intdigest(s, 42) for s in own], np.uint64))


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), 7) - (1 << 63)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _AT_ONCE):
        mixed = _FACTORS[:, None] * hashes[None, at:at + _AT_ONCE] + _OFFSETS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        own = [_hashes(shingles(t)) for t in rows["text"]]
        yield pd.DataFrame({"doc_id": rows["doc_id"].array, "node": [_node(h) for h in own], "n": [len(h) for h in own], "keys": [band_keys(h) for h in own],
                            "fp": np.array([simhash.fingerprint(t) for t in rows["text"]], np.uint64).view(np.int64)})


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    split = lru_cache(16)(shingles)
    for rows in batches:
        near = [jaccard(split(a), split(b)) >= SIMILAR for a, b in zip(rows["text_a"], rows["text_b"], strict=True)]
        yield rows.loc[near, ["a", "b"]]


def _of_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.loc[[_node(_hashes(shingles(t))) == n for t, n in zip(rows["text"], rows["node"], strict=True)], ["node", "text"]]


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame({"node": rows["node"].array, "hashes": [_hashes(shingles(t)).view(np.int64) for t in rows["text"]]})


def _texts_of(nodes: DataFrame, firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """node and text, one row or equal ones each, of the wanted nodes."""
    ids = firsts.join(nodes, "node", "left_semi").select("node", F.col("first_id").alias("doc_id"))
    # Rows of one id may differ in text: only those of the node count.
    return texts.join(ids, "doc_id").select("node", "text").mapInPandas(_of_node, "node long, text string")


def _similar(pairs: DataFrame, firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose shingles are similar enough."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    found = _texts_of(wanted, firsts, texts)
    one, other = (found.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    return pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b").mapInPandas(_compared, "a long, b long").distinct()


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * F.lit(SIMILAR)


def simhash_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes (fp, node, n) whose fingerprints are equal or linked: one node stands for each fingerprint."""
    heads = written(prints.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("head")), "simhash-classes")
    found = written(simhash.links(heads.select("fp")), "simhash-links")
    one, other = (heads.select(F.col("fp").alias(x), F.col("head").alias(f"head_{x}")) for x in "ab")
    linked = found.join(one, "a").join(other, "b").select(F.col("head_a").alias("x"), F.col("head_b").alias("y"))
    equal = prints.join(heads, "fp").select(F.col("head").alias("x"), F.struct("node", "n").alias("y"))
    near = linked.unionByName(equal).filter("x.node <> y.node").filter(_sizes_allow(F.col("x.n"), F.col("y.n")))
    return near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component of ``joined`` (node, component)."""
    one, other = (joined.select(F.col("node").alias(x), F.col("component").alias(f"component_{x}")) for x in "ab")
    both = pairs.join(one, "a", "left").join(other, "b", "left")
    return both.filter(F.coalesce("component_a", "a") != F.coalesce("component_b", "b")).select("a", "b")


def _families(members: DataFrame) -> DataFrame:
    """node, n, component, family (a component) and centre (a node of that component) for the nodes of keys (key, node, n, component)."""
    # Stored, so that the join can divide the rows of a large component.
    weights = written(members.groupBy("component").agg(F.count(F.lit(1)).alias("weight")), "near-weights")
    keys = members.join(weights, "component").groupBy("key").agg(F.max(F.struct("weight", "component")).alias("top"), F.count(F.lit(1)).alias("many"))
    nodes = members.join(keys, "key").groupBy("node", "n", "component").agg(F.max("top").alias("top"), F.sum("many").alias("met"))
    nodes = written(nodes, "near-left")
    found = nodes.groupBy("component").agg(F.max("top")["component"].alias("family"), F.max(F.struct("met", "node"))["node"].alias("centre"))
    found = written(found, "near-families")
    centres = found.select(F.col("component").alias("family"), "centre")
    return nodes.select("node", "n", "component").join(found.select("component", "family"), "component").join(centres, "family")


def _ordered(tokens: DataFrame, within: list[str]) -> DataFrame:
    """The rows of tokens (node, hash, size, least and others) that have a double ``within``, and ``rest``: how many of the node's tokens
    come here or later, from rare to frequent. Rows with fewer than ``least`` left are not needed."""
    counts = tokens.groupBy(*within, "hash").agg(F.count(F.lit(1)).alias("df"))
    others = [c for c in tokens.columns if c != "hash"]
    ordered = tokens.join(counts, [*within, "hash"]).groupBy(*others).agg(F.sort_array(F.collect_list(F.struct("df", "hash"))).alias("order"))
    placed = ordered.select(*others, F.posexplode("order").alias("at", "token")).withColumn("rest", F.col("size") - F.col("at"))
    return placed.filter("token.df > 1").filter(F.col("rest") >= F.col("least") - 1e-6).select(*others, "rest", F.col("token.hash").alias("hash"))


def _meeting(tokens: DataFrame, within: list[str], part: str, shared: Column) -> DataFrame:
    """Pairs (a, b) of nodes of different parts with a common token that leaves at least ``shared`` (of x and y) to have in common."""
    several = tokens.groupBy(*within, "hash").agg(F.min(part).alias("c"), F.max(part).alias("d")).filter("c < d").select(*within, "hash")
    kept = written(tokens.join(several, [*within, "hash"], "left_semi"), "near-prefixes")
    met = (F.col(f"x.{part}") < F.col(f"y.{part}")) & _sizes_allow(F.col("x.n"), F.col("y.n")) & (F.least("x.rest", "y.rest") >= shared - 1e-6)
    for name in [*within, "hash"]:
        met = (F.col(f"x.{name}") == F.col(f"y.{name}")) & met
    pairs = kept.alias("x").join(kept.alias("y"), met)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        sets = [[np.asarray(h, np.int64) for h in rows[c]] for c in ("hashes", "base")]
        changed = [np.setxor1d(h, c, assume_unique=True) for h, c in zip(*sets, strict=True)]
        both = [(len(h) + len(c) - len(e)) // 2 for h, c, e in zip(*sets, changed, strict=True)]
        near = [not k + len(e) or k / (k + len(e)) >= SIMILAR for k, e in zip(both, changed, strict=True)]
        yield pd.DataFrame({**{c: rows[c].array for c in ("node", "n", "component", "family", "centre")}, "base_n": [len(c) for c in sets[1]], "near": near, "changed": changed})


def prefix_pairs(nodes: DataFrame, firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes (node, n, component, family, centre) that may be similar and lie in different components.

    Components of all similar pairs of the nodes are those of the similar ones among these.
    """
    read = _texts_of(nodes.select("node"), firsts, texts).dropDuplicates(["node"])
    sets = written(read.mapInPandas(_tokens, "node long, hashes array<long>"), "near-tokens")
    n, m = F.col("x.n"), F.col("y.n")
    # The smallest share of a set of n that a similar one has, and of two sets.
    alone = sets.join(nodes.select("node", "n", "family"), "node").select("node", "n", "family", F.col("n").alias("size"), (F.col("n") * F.lit(SIMILAR)).alias("least"), F.explode("hashes").alias("hash"))
    pairs = _meeting(_ordered(alone, []), [], "family", (n + m) * F.lit(SIMILAR / (1 + SIMILAR)))

    several = nodes.groupBy("family").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c < d or c <> family").select("family")
    bases = sets.select(F.col("node").alias("centre"), F.col("hashes").alias("base"))
    inside = nodes.join(several, "family", "left_semi").join(sets, "node").join(bases, "centre")
    kind = "node long, n int, component long, family long, centre long, base_n int, near boolean, changed array<long>"
    changes = written(inside.mapInPandas(_changes, kind), "near-changes")
    to_centre = changes.filter("near and component <> family").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))

    allowed = F.lit((1 - SIMILAR) / (1 + SIMILAR))
    size, base = F.size("changed"), F.col("base_n")
    # What any node must share with this one: one that is similar to the centre meets none like it.
    least = (size + F.when(F.col("near"), base - F.col("n")).otherwise(-base - F.col("n")) * allowed) / 2
    part = F.when(F.col("near"), F.col("family")).otherwise(F.col("component"))
    tokens = changes.select("node", "n", "family", part.alias("part"), size.alias("size"), least.alias("least"), F.explode("changed").alias("hash"))
    pairs = pairs.unionByName(_meeting(_ordered(tokens, ["family"]), ["family"], "part", (F.col("x.size") + F.col("y.size") - (n + m) * allowed) / 2))
    return pairs.unionByName(to_centre).distinct()


def linked(docs: DataFrame) -> DataFrame:
    """doc_id and component_id, the smallest doc_id of all reachable documents; rows without an id are left out."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    signed = written(texts.mapInPandas(_signed, "doc_id long, node long, n int, keys array<long>, fp long"), "near-keys")
    firsts = written(signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n")), "near-nodes")
    alike = written(simhash_pairs(signed.select("fp", "node", "n").distinct()), "near-simhash")
    by_simhash = written(_similar(alike, firsts, texts), "near-links")
    joined = components(by_simhash)

    keyed = signed.select("node", "n", F.explode("keys").alias("key")).distinct()
    buckets = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("least"), F.max("node").alias("last")).filter("least.node < last")
    shared = written(keyed.join(buckets.select("key", "least"), "key"), "near-buckets")

    beside = shared.filter("node <> least.node").filter(_sizes_allow(F.col("n"), F.col("least.n")))
    beyond = beside.select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct()
    stars = written(_apart(beyond, joined).join(alike, ["a", "b"], "left_anti"), "near-stars")
    links = by_simhash.unionByName(written(_similar(stars, firsts, texts), "near-links"))
    joined = components(links).withColumnRenamed("node", "of")
    named = shared.join(joined, F.col("node") == F.col("of"), "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    split = named.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c < d").select("key")
    left = written(_families(written(named.join(split, "key"), "near-split")), "near-left")
    pairs = prefix_pairs(left, firsts, texts).join(stars.unionByName(alike), ["a", "b"], "left_anti")
    more = written(_similar(written(pairs, "near-pairs"), firsts, texts), "near-links")
    joined = components(links.unionByName(more)).withColumnRenamed("node", "of")

    roots = firsts.join(joined, F.col("node") == F.col("of"), "left").select("node", "first_id", F.coalesce("component", "node").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = roots.join(smallest, "root").select("node", "component_id")
    return signed.select("doc_id", "node").join(labels, "node").select("doc_id", "component_id")


def group_firsts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one document (the smallest doc_id) of each group left."""
    dropped = linked(docs).filter("doc_id <> component_id")
    return docs.join(dropped.select(F.col("doc_id").alias("__id")).distinct(), docs["doc_id"] == F.col("__id"), "left_anti")
