"""Phrases whose words stand together more often than chance, by vertical partitioning of suffix trees.

Every word starts a suffix of at most ``DEPTH`` words that ends with its piece of text. The tree of all
these suffixes never exists as a whole. One pass weighs word prefixes: the words of a language fall into
cells by hash, and each cell counts its suffixes, for prefixes of one, two and three words. Cells are
packed into groups under a budget of suffixes; a cell over the budget is divided by the next word instead.
A second pass deals the suffixes to their groups, and each group builds its own truncated subtree: sorted
leaves, whose totals over runs are the counts of all phrases. A node that spans several groups (its cell
was divided) adds up their totals. Counts are exact.

Suffixes travel in blocks: the block's words once, then numbers. A task folds equal suffixes first, so a
phrase that fills a third of all texts arrives as one leaf per block, and a group holds about
``leaves_per_group`` of them whatever the table's size. The driver holds one number per cell, four cells
per group.

Phrases of two and three words with at least ``least`` occurrences are scored at their weakest cut, see
``collocations``.

Cases: null texts are empty; a null language is ``und``; texts without words, an empty table and languages
without candidates give no rows. Repeated rows count again. A very long text is one block. Extra columns
are ignored. Equal scores go by count, then by phrase in byte order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .common import partitions_for, text_or_empty, written

DEPTH = 3
LEAST = 10
TOP = 2_000
INSIDE_PERCENT = 50
LEAVES_PER_GROUP = 1_500_000
CHUNK_CHARS = 8 << 20
LEAST_CELLS = 1 << 12
PARTS = 32
SCALE = 1_000_000

_UPPER, _LOWER, _CUTS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b".,;:!?\n\x0b\x0c\r"
# No UTF-8 text holds this byte.
_CUT = b"\xff"
_FOLDED = bytes.maketrans(_UPPER + _CUTS, _LOWER + _CUT * len(_CUTS))
_NODES = "lang string, depth int, first string, second string, third string, n long, whole boolean"
_GRAM = ["lang", "first", "second", "third"]


def tokens(texts: list[str]) -> list[bytes]:
    """The words of the texts in order, with a cut after each piece."""
    joined = "\n".join(texts).encode().translate(_FOLDED)
    return joined.replace(_CUT, b" " + _CUT + b" ").split()


@dataclass
class Leaves:
    """Distinct suffixes as numbers of words (0: none), sorted, with their counts; ``words[i]`` has number i + 1."""

    words: np.ndarray
    at: list[np.ndarray]
    n: np.ndarray

    @classmethod
    def folded(cls, words: np.ndarray, at: list[np.ndarray], n: np.ndarray) -> Leaves:
        a, b, c = at
        if len(words) < 1 << 21:
            order = np.argsort(a << 42 | b << 21 | c, kind="stable")
        else:
            order = np.lexsort((c, b, a))
        leaves = cls(words, [column[order] for column in at], n[order])
        starts = leaves.starts(DEPTH)
        if not len(starts):
            return leaves
        return cls(words, [column[starts] for column in leaves.at], np.add.reduceat(leaves.n, starts))

    def starts(self, depth: int) -> np.ndarray:
        """Where the first ``depth`` words change: the nodes of that depth."""
        if not len(self.n):
            return np.zeros(0, np.int64)
        new = np.zeros(len(self.n), bool)
        new[0] = True
        for column in self.at[:depth]:
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    def to_bytes(self, rows: slice) -> bytes:
        """Some of the leaves with the words they use."""
        used, numbers = np.unique(np.concatenate([column[rows] for column in self.at]), return_inverse=True)
        ends = 1 if used[0] == 0 else 0
        text = b"\n".join(self.words[used[ends:] - 1])
        n = self.n[rows]
        kinds = [np.dtype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64) for top in (len(used), int(n.max()))]
        head = np.array([len(n), len(text), kinds[0].itemsize, kinds[1].itemsize], np.int64).tobytes()
        body = (numbers + (1 - ends)).astype(kinds[0]).tobytes() + n.astype(kinds[1]).tobytes()
        return zstandard.ZstdCompressor(level=3).compress(head + text + body)

    @classmethod
    def merged(cls, blocks: list[bytes]) -> Leaves:
        lists, columns, counts, sizes = [], [], [], []
        for block in blocks:
            raw = zstandard.ZstdDecompressor().decompress(block)
            rows, length, wide, deep = np.frombuffer(raw, np.int64, 4)
            lists.append(raw[32:32 + length].split(b"\n"))
            sizes.append(len(lists[-1]))
            body = 32 + length
            columns.append(np.frombuffer(raw, f"u{wide}", 3 * rows, body).reshape(3, rows))
            counts.append(np.frombuffer(raw, f"u{deep}", rows, body + 3 * rows * wide))
        codes, words = pd.factorize(_objects([w for words in lists for w in words]))
        at, base = [[], [], []], 0
        for column, size in zip(columns, sizes, strict=True):
            numbers = np.concatenate([[0], codes[base:base + size] + 1])
            for to, numbered in zip(at, column, strict=True):
                to.append(numbers[numbered])
            base += size
        return cls.folded(words, [np.concatenate(c) for c in at], np.concatenate(counts).astype(np.int64))


def _objects(words: list[bytes]) -> np.ndarray:
    made = np.empty(len(words), object)
    made[:] = words
    return made


def suffixes(texts: list[str]) -> Leaves:
    codes, words = pd.factorize(_objects(tokens(texts)))
    cut = np.flatnonzero(words == _CUT)
    numbers = np.arange(1, len(words) + 1)
    if len(cut):
        numbers[cut[0]] = 0
        numbers[cut[0] + 1:] -= 1
        words = np.delete(words, cut[0])
    a = np.concatenate([numbers[codes], np.zeros(DEPTH, np.int64)])
    b = a[1:-2]
    c = np.where(b > 0, a[2:-1], 0)
    a = a[:-3]
    there = a > 0
    return Leaves.folded(words, [a[there], b[there], c[there]], np.ones(int(there.sum()), np.int64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cells(lang: str, leaves: Leaves, of: int) -> list[np.ndarray]:
    """The cells of each leaf's prefixes of one, two and three words."""
    hashed = np.array([0, *(xxhash.xxh64_intdigest(w) for w in leaves.words)], np.uint64)
    key, found = np.array([xxhash.xxh64_intdigest(lang.encode(), 1)], np.uint64), []
    for column in leaves.at:
        key = _mixed(hashed[column] + key * np.uint64(3))
        found.append((key % np.uint64(of)).astype(np.int64))
    return found


@dataclass
class Partition:
    """The group of each cell by length of the prefix; -1 where the cell is divided by the next word."""

    groups: list[np.ndarray]

    @classmethod
    def packed(cls, weights: list[np.ndarray], budget: int) -> Partition:
        groups, first = [], 0
        for depth, weight in enumerate(weights, 1):
            light = (weight <= budget) | (depth == DEPTH)
            order = np.argsort(-weight, kind="stable")
            order = order[light[order]]
            group = np.full(len(weight), -1, np.int32)
            if len(order):
                group[order] = first + np.cumsum(weight[order]) // budget
                first = int(group.max()) + 1
            groups.append(group)
        return cls(groups)

    def of(self, found: list[np.ndarray]) -> np.ndarray:
        group = self.groups[0][found[0]]
        for depth in (1, 2):
            divided = group < 0
            group[divided] = self.groups[depth][found[depth][divided]]
        return group


def _chunks(batches: Iterator[pd.DataFrame], chars: int) -> Iterator[tuple[str, list[str]]]:
    """Texts by language, about ``chars`` characters held at a time."""
    held, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= chars:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _weights(of: int, chars: int):
    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((DEPTH, of), np.int64)
        for lang, texts in _chunks(batches, chars):
            leaves = suffixes(texts)
            for depth, found in enumerate(cells(lang, leaves, of)):
                sums[depth] += np.bincount(found, leaves.n, of).astype(np.int64)
        depth, cell = np.nonzero(sums)
        yield pd.DataFrame({"depth": depth, "cell": cell, "n": sums[depth, cell]})

    return weigh


def _deal(partition: Partition, of: int, chars: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, texts in _chunks(batches, chars):
            leaves = suffixes(texts)
            if not len(leaves.n):
                continue
            group = partition.of(cells(lang, leaves, of))
            order = np.argsort(group, kind="stable")
            dealt, group = Leaves(leaves.words, [c[order] for c in leaves.at], leaves.n[order]), group[order]
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            stops = np.append(starts[1:], len(group))
            blocks = [dealt.to_bytes(slice(i, j)) for i, j in zip(starts, stops, strict=True)]
            yield pd.DataFrame({"lang": lang, "group": group[starts], "block": blocks})

    return deal


def _subtree(partition: Partition, of: int, least: int):
    """The counts a group knows: whole ones from ``least`` on, and its share of those of divided cells."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, leaves = key[0], Leaves.merged(list(rows["block"]))
        found = cells(lang, leaves, of)
        names = np.concatenate([[None], _objects([w.decode() for w in leaves.words])])
        out = [pd.DataFrame({"lang": [lang], "depth": [0], "first": [None], "second": [None], "third": [None],
                             "n": [int(leaves.n.sum())], "whole": [False]})]
        for depth in range(DEPTH, 0, -1):
            starts = leaves.starts(depth)
            totals = np.add.reduceat(leaves.n, starts)
            # A node lies in one group unless its own cell and those of its prefixes are divided.
            whole = np.ones(len(starts), bool)
            if depth < DEPTH:
                whole = ~np.all([group[cell[starts]] < 0 for group, cell in zip(partition.groups[:depth], found[:depth], strict=True)], axis=0)
            good = (leaves.at[depth - 1][starts] > 0) & (~whole | (totals >= least))
            words = [names[column[starts[good]]] if i < depth else None for i, column in enumerate(leaves.at)]
            out.append(pd.DataFrame({"lang": lang, "depth": depth, "first": words[0], "second": words[1], "third": words[2],
                                     "n": totals[good], "whole": whole[good]}))
        return pd.concat([o for o in out if len(o)], ignore_index=True)

    return build


def counts(docs: DataFrame, least: int = LEAST, leaves_per_group: int = LEAVES_PER_GROUP, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """lang, depth, first, second, third, n: phrases of one to three words with ``least`` occurrences or more.

    Rows of depth 0 hold the number of words of a language.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    # A word takes two characters at least.
    of = max(LEAST_CELLS, 4 * partitions_for(chars // 2, leaves_per_group))
    weighed = rows.mapInPandas(_weights(of, chunk_chars), "depth int, cell long, n long").groupBy("depth", "cell").agg(F.sum("n").alias("n")).toPandas()
    weights = [np.zeros(of, np.int64) for _ in range(DEPTH)]
    for depth, part in weighed.groupby("depth"):
        weights[depth][part["cell"]] = part["n"]
    partition = Partition.packed(weights, leaves_per_group)
    dealt = rows.mapInPandas(_deal(partition, of, chunk_chars), "lang string, group int, block binary")
    # About one group per task.
    tasks = partitions_for(int(weights[0].sum()), leaves_per_group, docs.sparkSession.sparkContext.defaultParallelism)
    nodes = written(dealt.repartition(tasks, "lang", "group").groupBy("lang", "group").applyInPandas(_subtree(partition, of, least), _NODES), "phrase-counts")
    shares = nodes.filter("not whole").groupBy("lang", "depth", "first", "second", "third").agg(F.sum("n").alias("n"))
    return nodes.filter("whole").drop("whole").unionByName(shares.filter((F.col("depth") == 0) | (F.col("n") >= least)))


def _scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The weakest cut of each phrase in whole numbers of any size."""
    for rows in batches:
        out = []
        for a, cuts in zip(rows["a"], rows["cuts"], strict=True):
            score, k = min((SCALE * int(a) * int(a) // (int(c["l"]) * int(c["r"])), k) for k, c in enumerate(cuts))
            out.append((int(cuts[k]["l"]), int(cuts[k]["r"]), score))
        scored = pd.DataFrame(out, columns=["l", "r", "score"], index=rows.index).astype("int64")
        yield pd.concat([rows[["lang", "phrase", "a"]], scored], axis=1)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, inside_percent: int = INSIDE_PERCENT, **sizes: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    a, l, r: occurrences of the phrase, of its first and of its last part at the cut of the lowest score
    (of equal ones the first); n: words of the language; score: floor(1,000,000 a a / (l r)). A phrase is
    left out where a longer one around it has ``inside_percent`` of its occurrences.
    """
    found = counts(docs, least, **sizes)
    of = {depth: found.filter(F.col("depth") == depth) for depth in range(DEPTH + 1)}

    def looked_up(rows: DataFrame, count: str, *names: str) -> DataFrame:
        """Add the count of the phrase made of the named columns."""
        keys = ("first", "second")[:len(names)]
        table = of[len(names)].select(F.col("lang").alias("_lang"), *[F.col(k).alias(f"_{k}") for k in keys], F.col("n").alias(count))
        same = F.col("lang") == F.col("_lang")
        for name, key in zip(names, keys, strict=True):
            same = same & (F.col(name) == F.col(f"_{key}"))
        return rows.join(table, same).drop("_lang", *[f"_{k}" for k in keys])

    three = of[3].select(*_GRAM, F.col("n").alias("a"))
    around = three.select("lang", "first", "second", "a").unionByName(three.select("lang", F.col("second").alias("first"), F.col("third").alias("second"), "a"))
    longest = around.groupBy("lang", "first", "second").agg(F.max("a").alias("_longer"))
    two = of[2].select(*_GRAM, F.col("n").alias("a")).join(longest, ["lang", "first", "second"], "left")
    two = two.filter(F.coalesce(100 * F.col("_longer") < inside_percent * F.col("a"), F.lit(True))).drop("_longer")
    two = looked_up(looked_up(two, "l1", "first"), "r1", "second").select(
        "lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", F.array(F.struct(F.col("l1").alias("l"), F.col("r1").alias("r"))).alias("cuts"))
    three = looked_up(looked_up(three, "l1", "first"), "r1", "second", "third")
    three = looked_up(looked_up(three, "l2", "first", "second"), "r2", "third").select(
        "lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a",
        F.array(*[F.struct(F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]).alias("cuts"))
    scored = two.unionByName(three).mapInPandas(_scores, "lang string, phrase string, a long, l long, r long, score long")
    # A language's phrases are first cut down in parts, so its last task gets PARTS * top rows at most.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = parted.withColumn("rank", first).filter(F.col("rank") <= top).withColumn("rank", last).filter(F.col("rank") <= top)
    words = of[0].select("lang", "n")
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
