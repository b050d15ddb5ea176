"""Toxicity by nearest labelled examples.

1. Examples: at most ``per_class`` labelled rows of each class and ``calibration``
   more rows of both, taken by a hash of the id. These bounds are parameters of
   the fit; everything else covers all data.
2. Features: words in lower case and their beginnings of four and five letters.
   The vocabulary are all features of the examples, as sorted 64-bit hashes.
3. Document frequencies for the vocabulary over all documents; TF-IDF vectors
   of unit length (1 + ln tf) * (ln((1+n)/(1+df)) + 1) * (1 + chi-square), where
   chi-square tells how far presence in the examples depends on the class. It
   weighs features and leaves none out.
4. Each document's nearest examples by exact cosine (block-max inverted index
   of sparse postings). Every example is in the index. Examples with equal vectors
   are one entry with its counts of labels. Votes weigh 1 / (0.05 + distance); a
   small prior keeps sparse votes moderate.
5. Isotonic regression on the calibration rows turns votes into scores, where there
   are ``least_calibration`` of them; else votes are the scores.

A document without any feature of the examples has no neighbour; its vote is
the prior, calibrated like all others. Evidence lists the nearest example ids.

Cases: null and empty texts have no feature; labels that are null are not
learnt from; without examples of both classes every score is the share of toxic
rows, 0 without any; repeated rows
are scored alike; an empty table gives an empty result; other columns are
ignored, so lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .blockmax import BlockMaxIndex, Rows
from .common import written

_WORD = re.compile(r"[^\W_]+")
PREFIXES = (4, 5)
_ROWS_AT_ONCE = 512
_CHARS_AT_ONCE = 1 << 22
_HEADS_HELD = 1 << 17


@dataclass(frozen=True)
class Settings:
    per_class: int = 2048
    calibration: int = 4096
    neighbours: int = 10
    least_calibration: int = 50
    threshold: float = 0.3
    seed: int = 42


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def features(counts: Counter) -> Counter:
    found = Counter(counts)
    for word, n in counts.items():
        for size in PREFIXES:
            if len(word) >= size:
                found["^" + word[:size]] += n
    return found


def term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))


class _Heads(dict):
    """Hashes of the beginnings of words; there are far fewer of them than words."""

    def __missing__(self, head: str) -> int:
        if len(self) >= _HEADS_HELD:
            self.clear()
        self[head] = hashed = term_hash("^" + head)
        return hashed


_heads = _Heads()


def _features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For words and each kind of beginning: hashes of the different ones, and text number and hash number of all that occur."""
    words = [_WORD.findall((t or "").lower()) for t in texts]
    text = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.empty(len(text), object)
    flat[:] = [w for own in words for w in own]
    code, unique = pd.factorize(flat)
    unique = list(unique)
    # As term_hash: words hold no lone surrogates.
    yield np.fromiter(map(xxhash.xxh64_intdigest, unique), np.uint64, len(unique)), text, code
    for size in PREFIXES:
        fits = np.fromiter(map(len, unique), np.int64, len(unique)) >= size
        number = np.cumsum(fits) - 1
        own = fits[code]
        yield np.fromiter(map(_heads.__getitem__, [w[:size] for w in unique if len(w) >= size]), np.uint64, int(fits.sum())), text[own], number[code[own]]


def _counted(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each occurs."""
    cell = np.sort(cell)
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    return cell[starts], np.diff(np.append(starts, len(cell)))


def occurrences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, feature (as a hash) and count, sorted, of each feature of each text."""
    found = list(_features(texts))
    every = np.unique(np.concatenate([hashes for hashes, _, _ in found]))
    text, at, n = placed_occurrences(found, every)
    return text, every[at], n


def placed_occurrences(found: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place in the vocabulary (sorted hashes) and count, sorted, of each of the ``_features`` that the vocabulary has."""
    cells = [np.zeros(0, np.int64)]
    for hashes, text, number in found:
        at = _placed(vocabulary, hashes)[number]
        known = at >= 0
        cells.append(text[known] * len(vocabulary) + at[known])
    cell, n = _counted(np.concatenate(cells))
    text, at = np.divmod(cell, max(1, len(vocabulary)))
    return text, at, n


def _placed(vocabulary: np.ndarray, term: np.ndarray) -> np.ndarray:
    """The places of hashes in the vocabulary, -1 for others."""
    if not len(vocabulary):
        return np.full(len(term), -1)
    at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
    return np.where(vocabulary[at] == term, at, -1)


def _portions(texts: pd.Series) -> Iterator[list[str | None]]:
    """A batch in parts of bounded rows and characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if len(held) >= _ROWS_AT_ONCE or size >= _CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _chosen(labels: DataFrame, s: Settings) -> DataFrame:
    """The ids to learn from (role 0) and to calibrate on (role 1), bounded by the settings."""
    rows = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("y"))
    rows = rows.withColumn("__h", F.xxhash64(F.lit(s.seed), "__id"))
    to_learn = F.pmod(F.xxhash64(F.lit(s.seed + 1), "__id"), F.lit(3)) < 2

    def first(which: Column, n: int, role: int) -> DataFrame:
        return rows.filter(which).orderBy("__h", "__id").limit(n).select("__id", "y", F.lit(role).alias("role"))

    learnt = first(to_learn & (F.col("y") == 1), s.per_class, 0).unionByName(first(to_learn & (F.col("y") == 0), s.per_class, 0))
    return learnt.unionByName(first(~to_learn, s.calibration, 1)).dropDuplicates(["__id"])


@dataclass
class Model:
    vocabulary: np.ndarray
    weights: np.ndarray
    index: BlockMaxIndex
    votes: np.ndarray
    ids: list[int]
    prior: float
    cuts: np.ndarray
    levels: np.ndarray
    settings: Settings

    def vectors(self, texts) -> Rows:
        text, at, n = placed_occurrences(_features(list(texts)), self.vocabulary)
        ends = np.searchsorted(text, np.arange(len(texts) + 1))
        return _weighed(ends, at.astype(np.int32), n, self.weights)

    def raw(self, vectors: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Votes, and the similarities and places of the neighbours."""
        near, places = self.index.search(vectors, self.settings.neighbours)
        weights = np.where(near > 1e-6, 1 / (0.05 + np.clip(1 - near, 0, 1)), 0)
        counts = self.votes[np.minimum(places, max(0, len(self.votes) - 1))] if len(self.votes) else np.zeros((*places.shape, 2))
        toxic, all_votes = (weights * counts[..., 0]).sum(axis=1), (weights * counts[..., 1]).sum(axis=1)
        return (toxic + self.prior) / (all_votes + 1), near, places

    def score(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.cuts):
            return raw
        return np.interp(raw, self.cuts, self.levels)


def _weighed(ends: np.ndarray, at: np.ndarray, tf: np.ndarray, weights: np.ndarray) -> Rows:
    data = (1 + np.log(tf)) * weights[at]
    sizes = np.diff(ends)
    norms = np.sqrt(np.bincount(np.repeat(np.arange(len(sizes)), sizes), data * data, len(sizes)))
    return Rows(ends, at, (data / np.repeat(norms, sizes)).astype(np.float32), len(weights))


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots for interpolation, levels smoothed by half a case."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for v, t in zip(x[order], y[order], strict=True):
        if pools and pools[-1][3] == v:
            pools[-1][0] += t
            pools[-1][1] += 1
        else:
            pools.append([t, 1, v, v])
    stack: list[list[float]] = []
    for p in pools:
        stack.append(p)
        while len(stack) > 1 and stack[-2][0] / stack[-2][1] >= stack[-1][0] / stack[-1][1]:
            t, n, lo, hi = stack.pop()
            stack[-1] = [stack[-1][0] + t, stack[-1][1] + n, stack[-1][2], hi]
    cuts = np.array([v for p in stack for v in (p[2], p[3])])
    levels = np.repeat([(p[0] + 0.5 * (p[0] / p[1])) / (p[1] + 0.5) for p in stack], 2)
    keep = np.concatenate([[True], np.diff(cuts) > 0]) if len(cuts) else np.zeros(0, bool)
    return cuts[keep], levels[keep]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    s = settings or Settings()
    spark = docs.sparkSession
    chosen = _chosen(labels, s)
    # At most 2 * per_class + calibration ids, a bound of the settings.
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = small.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))

    def terms_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, one in rows.groupby(np.arange(len(rows)) // _ROWS_AT_ONCE):
                text, term, n = occurrences(list(one["text"]))
                ends = np.searchsorted(text, np.arange(len(one) + 1))
                parts = list(zip(ends, ends[1:]))
                yield pd.DataFrame({"doc_id": one["doc_id"].array, "y": one["y"].array, "role": one["role"].array,
                                    "terms": [term[i:j].view(np.int64) for i, j in parts], "counts": [n[i:j].astype(np.int32) for i, j in parts]})

    seen = written(sample.mapInPandas(terms_of, "doc_id long, y int, role int, terms array<long>, counts array<int>"), "toxic-examples")
    sizes = {int(r["y"]): int(r["n"]) for r in seen.filter("role = 0").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    natural, known = seen.filter("role = 1").agg(F.avg("y"), F.count(F.lit(1))).first()
    base = float(natural) if natural is not None else toxic / max(1, toxic + clean)
    unlearnt = Model(np.zeros(0, np.uint64), np.zeros(0), BlockMaxIndex(np.zeros((0, 0), np.float32)), np.zeros((0, 2)), [], base, np.zeros(0), np.zeros(0), s)
    if not toxic or not clean:
        return unlearnt

    # All terms of at most 2 * per_class examples, a bound of the settings.
    by_term = seen.filter("role = 0").select(F.explode("terms").alias("term"), "y").groupBy("term").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n")).toArrow()
    term, a, n = (by_term[c].to_numpy() for c in ("term", "a", "n"))
    term = term.astype(np.int64).view(np.uint64)
    order = np.argsort(term)
    vocabulary, a, n, all_n = term[order], a[order].astype(float), n[order].astype(float), float(toxic + clean)
    del by_term, term, order
    chi2 = all_n * (a * clean - (n - a) * toxic) ** 2 / np.maximum(n * (all_n - n) * toxic * clean, 1)
    words = spark.sparkContext.broadcast(vocabulary)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(len(words.value), np.int64), 0
        for rows in batches:
            for texts in _portions(rows["text"]):
                df += np.bincount(placed_occurrences(_features(texts), words.value)[1], minlength=len(df))
            total += len(rows)
        some = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.concatenate([[-1], some]), "df": np.concatenate([[total], df[some]])})

    counted = small.select("text").mapInPandas(frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    counted = counted.toArrow()  # one row per term of the vocabulary
    place, often = counted["term"].to_numpy(), counted["df"].to_numpy()
    total, df = often[place < 0].sum(), np.zeros(len(vocabulary))
    df[place[place >= 0]] = often[place >= 0]
    del counted, place, often
    weights = (np.log((1 + total) / (1 + df)) + 1) * (1 + chi2)
    del a, n, df, chi2

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at, n = [], []
            for terms, counts in zip(rows["terms"], rows["counts"], strict=True):
                place = _placed(words.value, np.asarray(terms, np.int64).view(np.uint64))
                at.append(place[place >= 0].astype(np.int32).tobytes())
                n.append(np.asarray(counts, np.int32)[place >= 0].tobytes())
            yield pd.DataFrame({"doc_id": rows["doc_id"], "y": rows["y"], "at": at, "n": n})

    # One row per example: bounded by the settings. The calibration rows stay with the executors.
    learnt = seen.filter("role = 0").mapInPandas(packed, "doc_id long, y int, at binary, n binary").orderBy("doc_id").toArrow()
    own = _weighed(*_unpacked(learnt), weights)
    y, ids = learnt["y"].to_numpy(), learnt["doc_id"].to_numpy()
    del learnt
    words.destroy()

    places: dict[tuple[bytes, bytes], int] = {}
    ends, rounded = own.ends, np.round(own.data, 5)
    group = np.array([places.setdefault((own.at[i:j].tobytes(), rounded[i:j].tobytes()), len(places)) for i, j in zip(ends, ends[1:])], int)
    del places, rounded
    first = np.unique(group, return_index=True)[1]
    # The classes are sampled apart: weigh them back to their shares.
    share = np.where(y == 1, base / toxic, (1 - base) / clean) * (toxic + clean)
    votes = np.zeros((len(first), 2))
    np.add.at(votes[:, 0], group, share * (y == 1))
    np.add.at(votes[:, 1], group, share)
    index = BlockMaxIndex(own if len(first) == len(own) else own.take(first))
    del own
    model = Model(vocabulary, weights, index, votes, [int(i) for i in ids[first]], base, np.zeros(0), np.zeros(0), s)
    if known >= s.least_calibration:
        model.cuts, model.levels = _isotonic(*_calibration(seen.filter("role = 1"), model))
    return model


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the rows, and the places and counts of all of them side by side."""
    at, n = (np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(x.as_buffer(), np.int32) for x in rows[c])]) for c in ("at", "n"))
    return np.cumsum([0, *pc.binary_length(rows["at"]).to_pylist()]) // 4, at, n


def _calibration(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Votes and labels of the calibration rows: two numbers for each, bounded by the settings."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def votes_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        for batch in batches:
            for _, one in batch.groupby(np.arange(len(batch)) // _ROWS_AT_ONCE):
                at = [_placed(m.vocabulary, np.asarray(t, np.int64).view(np.uint64)) for t in one["terms"]]
                n = [np.asarray(c, np.int32)[a >= 0] for c, a in zip(one["counts"], at, strict=True)]
                at = [a[a >= 0].astype(np.int32) for a in at]
                vectors = _weighed(np.cumsum([0, *map(len, at)]), np.concatenate(at), np.concatenate(n), m.weights)
                yield pd.DataFrame({"vote": m.raw(vectors)[0], "y": one["y"].array})

    found = rows.mapInPandas(votes_of, "vote double, y int").toArrow()
    shared.destroy()
    return found["vote"].to_numpy(), found["y"].to_numpy()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, evidence (ids of the nearest examples) and their similarities."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by Settings

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        for batch in batches:
            at = 0
            for texts in _portions(batch["text"]):
                raw, near, places = m.raw(m.vectors(texts))
                score = np.clip(m.score(raw), 0, 1)
                real = near > 1e-6
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[at:at + len(texts)].array, "score": score.astype(float), "predicted": (score >= m.settings.threshold).astype(np.int32),
                    "evidence": [[m.ids[p] for p in row[ok][:3]] for row, ok in zip(places, real, strict=True)],
                    "similarity": [[float(v) for v in row[ok][:3]] for row, ok in zip(near, real, strict=True)],
                })
                at += len(texts)

    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return small.mapInPandas(each, "doc_id long, score double, predicted int, evidence array<long>, similarity array<double>")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by Settings

    @F.pandas_udf("boolean")
    def rejected(texts: pd.Series) -> pd.Series:
        m: Model = shared.value
        parts = [m.score(m.raw(m.vectors(part))[0]) for part in _portions(texts)]
        return pd.Series(np.concatenate([np.zeros(0), *parts]) >= m.settings.threshold)

    return docs.filter(~rejected(F.col("text").cast("string")))
