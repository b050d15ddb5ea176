"""Repeated passages of words, located by Aho-Corasick automata.

1. Confirm: six-word phrases, sampled so that every window of ``window`` words has
   one, are counted over the documents; those of several documents recur.
2. Compile: each run of documents becomes one shard. Its automaton holds the
   recurring phrases that its documents are known to have, and no other.
3. Stream: the shard's documents pass through the automaton, which locates every
   occurrence; windows whose sampled phrase recurs there are compared with those of
   all other documents by a 96-bit hash of their words.
4. A window that also starts in a document with a smaller doc_id is removed. Within
   a run of documents the first one answers for the others, so a passage in a third
   of all documents sends a row per run.

Cases: null and blank texts have no words; rows that share a doc_id (or have none)
never remove each other, and rows without one give way to all others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .recurring import TOP, chunks, covered, gram_hashes, mixed, recurring, runs_of, sliding_min, with_ids

WINDOW = 13
PHRASE = 6
_CHARS_AT_ONCE = 4_000_000


def words_of(text: str) -> list[bytes]:
    """Maximal runs of anything but ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def _tokens(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


class _Batch:
    """The words of some texts in one line, with where each text begins."""

    def __init__(self, texts: list[str], window: int, phrase: int):
        self.words = [words_of(t) for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.tokens = _tokens([w for own in self.words for w in own])
        self.row = np.repeat(np.arange(len(texts)), self.sizes)
        self.width = window - phrase + 1
        self.phrases = gram_hashes(self.tokens, phrase)
        n = len(self.phrases)
        # A phrase or window that would run over a text's end does not exist.
        self.phrases[self.starts[self.row[:n] + 1] - np.arange(n) < phrase] = TOP
        self.whole = np.flatnonzero(self.starts[self.row + 1] - np.arange(len(self.row)) >= window)

    def anchors(self) -> np.ndarray:
        mask = np.zeros(len(self.phrases), bool)
        low = sliding_min(self.phrases, self.width) if len(self.phrases) >= self.width else np.zeros(0, np.uint64)
        self.low = low
        full = np.full(len(low), np.uint64(0))
        full[self.whole] = low[self.whole]      # only windows within a text choose
        pad = np.zeros(self.width - 1, np.uint64)
        if len(low):
            highest = ~sliding_min(~np.concatenate([pad, full, pad]), self.width)
            mask = (self.phrases == highest[:len(mask)]) & (self.phrases != TOP)
        return np.flatnonzero(mask)


def _anchors(window: int, phrase: int):
    def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        batch = _Batch(texts, window, phrase)
        at = batch.anchors()
        return batch.phrases[at], batch.row[at]

    return anchors


def _automaton(batch: _Batch, known: list[np.ndarray], phrase: int) -> ahocorasick.Automaton:
    """The recurring phrases of these documents, each between blanks."""
    at = batch.anchors()
    found = ahocorasick.Automaton()
    marks = batch.phrases[at]
    every = np.unique(np.concatenate([np.zeros(0, np.int64), *known])).view(np.uint64)
    for p in at[np.isin(marks, every)]:
        row = batch.row[p]
        first = p - batch.starts[row]
        text = b" %b " % b" ".join(batch.words[row][first:first + phrase])
        found.add_word(text.decode("latin-1"), len(text))
    if len(found):
        found.make_automaton()
    return found


def _located(batch: _Batch, automaton: ahocorasick.Automaton) -> np.ndarray:
    """Which places of the line begin a recurring phrase."""
    hit = np.zeros(len(batch.tokens), bool)
    if not len(automaton):
        return hit
    for row, words in enumerate(batch.words):
        if not words:
            continue
        line = b" %b " % b" ".join(words)
        begins = [end - size + 1 for end, size in automaton.iter(line.decode("latin-1"))]
        if begins:
            blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            hit[batch.starts[row] + np.searchsorted(blanks, begins)] = True
    return hit


def _windows(batch: _Batch, hit: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows whose sampled phrase recurs."""
    if not hit.any() or not len(batch.whole):
        return np.zeros(0, np.int64)
    marked = np.where(hit[:len(batch.phrases)], batch.phrases, TOP)
    low = sliding_min(marked, batch.width)
    return batch.whole[low[batch.whole] == batch.low[batch.whole]]


# ``mark`` holds the second 32 bits of a window's hash and its start (of a removed run:
# its words and start), ``what`` the id and the kind of the row.
_SENT = "key long, mark long, what long"
_WINDOW, _SEVERAL, _RUN = 0, 1, 2


def _compare(window: int, phrase: int, shared: int):
    """Sent rows: windows of the first document that has them here, and removed runs of the others."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for part in chunks(whole["text"].str.len().to_numpy(), _CHARS_AT_ONCE):
                rows = whole.iloc[part]
                batch = _Batch(rows["text"].tolist(), window, phrase)
                hit = _located(batch, _automaton(batch, [np.asarray(h, np.int64) for h in rows["hs"]], phrase))
                at = _windows(batch, hit, window)
                ids = rows["id"].to_numpy()
                key, check = gram_hashes(batch.tokens, window)[at], gram_hashes(batch.tokens ^ np.uint64(0x5BD1E995), window)[at].astype(np.uint32).view(np.int32)
                doc = ids[batch.row[at]] // shared
                order = np.lexsort((at, doc, check, key))
                k, c, d = key[order], check[order], doc[order]
                new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
                lead = d[new][np.cumsum(new) - 1] if len(k) else d
                later = np.zeros(len(batch.tokens), bool)
                later[at[order[d > lead]]] = True
                cover = np.zeros(len(later) + 1, np.int64)
                np.add.at(cover, np.flatnonzero(later), 1)
                np.add.at(cover, np.minimum(np.flatnonzero(later) + window, len(later)), -1)
                gone = np.cumsum(cover)[:len(later)] > 0
                # Runs end with their text.
                starts, sizes = runs_of(gone)
                starts, sizes = _cut(starts, sizes, batch.starts)
                # One row for a window of the first document, however often it has it.
                first = order[d == lead]
                place = at[first]
                row, run_row = batch.row[place], batch.row[starts] if len(starts) else np.zeros(0, np.int64)
                own = np.flatnonzero(np.concatenate([[True], (key[first][1:] != key[first][:-1]) | (check[first][1:] != check[first][:-1]) | (row[1:] != row[:-1])])) if len(first) else np.zeros(0, np.int64)
                several = np.diff(np.append(own, len(first))) > 1
                first, place, row = first[own], place[own], row[own]
                with np.errstate(over="ignore"):
                    apart = mixed(ids[run_row].astype(np.uint64) * TOP + starts.astype(np.uint64)).view(np.int64)
                yield pd.DataFrame({
                    "key": np.concatenate([key[first].view(np.int64), apart]),
                    "mark": np.concatenate([check[first].astype(np.int64) << 32 | (place - batch.starts[row]), sizes << 32 | (starts - batch.starts[run_row])]),
                    "what": np.concatenate([ids[row] * 4 + np.where(several, _SEVERAL, _WINDOW), ids[run_row] * 4 + _RUN]),
                })

    return each


def _cut(starts: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split runs at the bounds."""
    if not len(starts):
        return starts, sizes
    ends = starts + sizes
    points = np.unique(np.concatenate([starts, bounds[(np.searchsorted(starts, bounds, "right") > 0)]]))
    run = np.searchsorted(starts, points, "right") - 1
    inside = points < ends[run]
    points, run = points[inside], run[inside]
    following = np.append(points[1:], np.iinfo(np.int64).max)
    return points, np.minimum(following, ends[run]) - points


def _every(words: list[bytes], starts: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of size zero stand for all windows with the same words."""
    several = starts[sizes == 0]
    if not len(several):
        return starts, sizes
    keys = gram_hashes(_tokens(words), window)
    found = np.flatnonzero(np.isin(keys, keys[several]))
    return np.concatenate([starts[sizes > 0], found]), np.concatenate([sizes[sizes > 0], np.full(len(found), window)])


def _finish(window: int):
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text, starts, sizes in zip(rows["text"], rows["starts"], rows["sizes"], strict=True):
                words = words_of(text)
                if starts is not None and len(starts):
                    starts, sizes = _every(words, np.asarray(starts, np.int64), np.asarray(sizes, np.int64), window)
                    gone = covered(starts, sizes, len(words))
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    kept = words
                joined = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "replace")))
            yield pd.DataFrame({"doc_id": rows["doc_id"], "n_words": [o[0] for o in out], "n_removed": [o[1] for o in out], "kept_sha256": [o[2] for o in out], "kept_text": [o[3] for o in out]})

    return each


def removed_spans(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """doc_id, text, starts, sizes: the spans of words to remove from each document.

    A span of size zero stands for all windows of the document with the words of the one at its start.
    """
    rows, shared = with_ids(docs)
    hs = recurring(rows, _anchors(window, phrase), _CHARS_AT_ONCE)
    sent = rows.join(hs, "id").mapInPandas(_compare(window, phrase, shared), _SENT)
    doc = F.expr(f"id div {shared}")
    kind, upper = F.col("what").bitwiseAND(F.lit(3)), F.shiftright("mark", 32)
    opened = sent.repartition("key").select("key", upper.alias("upper"), F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("start"), F.shiftright("what", 2).alias("id"), kind.alias("kind"))
    judged = opened.withColumn("lead", F.min(doc).over(Window.partitionBy("key", "upper")))
    gone = judged.filter((F.col("kind") == _RUN) | (doc > F.col("lead")))
    size = F.when(F.col("kind") == _RUN, F.col("upper")).when(F.col("kind") == _SEVERAL, 0).otherwise(window)
    spans = gone.select("id", "start", size.cast("int").alias("size"))
    per_doc = spans.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    found = rows.join(per_doc, "id", "left")
    number = F.expr(f"id div {shared}")
    if shared == 1:
        return found.select(number.alias("doc_id"), "text", "starts", "sizes")
    known = docs.select(F.max(F.col("doc_id").cast("long"))).first()[0]
    return found.select(F.when(number <= F.lit(known), number).alias("doc_id"), "text", "starts", "sizes")


def deduplicated(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every document."""
    return removed_spans(docs, window, phrase).mapInPandas(_finish(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
