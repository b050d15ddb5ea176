"""Repeated byte strings through suffix arrays of shards.

1. Every window of ``window`` bytes has an anchor, its n-gram with the smallest
   hash. An anchor's region is the bytes of all windows that contain it. Equal
   windows have equal anchors, so they are found by comparing regions of one anchor.
2. Anchors are grouped over all documents. Where a whole region also stands in a
   smaller document, all of it is removed. An anchor with several regions needs a
   closer look; one with a single region or document is done.
3. The open regions go to shards by their anchor. Each shard sorts its suffixes
   (Larsson-Sadakane), takes common prefixes (Kasai) and so finds the windows that
   are equal. An anchor with many regions, as around a passage in a third of all
   documents, is dealt over all shards by document.
4. For those, shards send their first document of each window to merging parts by
   the window's hash, as sorted runs; a binary search in the merged run gives the
   first document of all shards.

Cases: null texts are empty; texts shorter than the window lose nothing; rows that
share a doc_id (or have none) never remove each other, rows without one give way
to all others; an empty table gives an empty result; other columns are ignored.
Cut characters: a run may end inside a UTF-8 character; ``kept_text`` shows U+FFFD
there, ``kept_sha256`` is taken from the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import partitions_for
from .recurring import TOP, chunks, covered, gram_hashes, mixed, runs_of, sliding_min, with_ids
from .suffixes import common_prefixes, suffix_array

WINDOW = 50
GRAM = 20
# Regions of an anchor from which they are dealt over all shards: in a run of documents, and in all.
MANY = 64
MANY_IN_ALL = 20_000
SHARD_BYTES = 8 * 1024 * 1024
_CHARS_AT_ONCE = 2_000_000
_HASH_BITS = np.uint64(40)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class _Batch:
    def __init__(self, texts: list[str], window: int, gram: int):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.window, self.gram, self.width = window, gram, window - gram + 1

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the anchors, their hashes, and the text of each."""
        grams = gram_hashes(self.bytes, self.gram) >> (np.uint64(64) - _HASH_BITS)
        n = len(self.bytes)
        if n < self.window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        low = sliding_min(grams, self.width)
        # Windows that cross from text to text choose nothing.
        for b in self.starts[1:-1]:
            low[max(0, b - self.window + 1):b] = 0
        pad = np.zeros(self.width - 1, np.uint64)
        highest = ~sliding_min(~np.concatenate([pad, low, pad]), self.width)
        at = np.flatnonzero(grams == highest[:len(grams)])
        row = np.searchsorted(self.starts, at, "right") - 1
        inside = (at + self.gram <= self.starts[row + 1]) & (self.sizes[row] >= self.window)
        return at[inside], grams[at[inside]], row[inside]

    def regions(self, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        span = self.width - 1
        return np.maximum(at - span, self.starts[row]), np.minimum(at + self.gram + span, self.starts[row + 1])

    def region_hashes(self, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.bytes), _BASE)]), dtype=np.uint64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[self.bytes] * up[:-1], dtype=np.uint64)])
            down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.bytes), _UNBASE)]), dtype=np.uint64)
            return mixed((sums[end] - sums[begin]) * down[begin] + (at - begin).astype(np.uint64) * np.uint64(1000003) + (end - at).astype(np.uint64))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
# One row is 40 bits of the anchor's hash, 32 of the region's, the id, the place and
# the kind. Full words keep the shuffled rows small: ``mark`` is the anchor with the
# region's upper 24 bits, ``rest`` the place, its lower eight bits and the kind, with its
# halves swapped. ``h`` is the anchor where ``mark`` has a random one to spread the rows.
# In this order the zero bytes of a row and the next are one run, which packs better.
_SENT = "h long, rest long, mark long, id long"
# What a sent row is: an occurrence to judge, a note about its anchor, one that is
# removed for sure, one that is open for sure.
_JUDGE, _NOTE, _GONE, _OPEN = 0, 1, 2, 3
# In place of an anchor: removed; added to it: with many regions.
_REMOVED, _HOT = -1, 1 << 41


def _occurrences(window: int, gram: int, shared: int):
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for part in chunks(whole["text"].str.len().to_numpy(), _CHARS_AT_ONCE):
                rows = whole.iloc[part]
                batch, ids = _Batch(rows["text"].tolist(), window, gram), rows["id"].to_numpy()
                at, h, row = batch.anchors()
                if len(at):
                    yield _sent(batch, ids, at, h, row, shared)

    return each


def _sent(batch: _Batch, ids: np.ndarray, at: np.ndarray, h: np.ndarray, row: np.ndarray, shared: int) -> pd.DataFrame:
    region = batch.region_hashes(at, *batch.regions(at, row)) >> np.uint64(32)
    doc = ids[row] // shared
    order = np.lexsort((doc, region, h))
    at, h, row, region, doc = at[order], h[order], row[order], region[order], doc[order]
    new_h = np.concatenate([[True], h[1:] != h[:-1]])
    new = new_h | np.concatenate([[True], region[1:] != region[:-1]])
    lead = doc[new][np.cumsum(new) - 1]
    group = np.cumsum(new_h) - 1
    variants = np.bincount(group, weights=new)
    firsts = np.flatnonzero(new_h)
    low, high = np.minimum.reduceat(doc, firsts), np.maximum.reduceat(doc, firsts)
    hot = (variants > MANY) & (low < high)
    kind = np.where(doc > lead, _GONE, np.where(hot[group], _OPEN, _JUDGE)).astype(np.int64)
    with np.errstate(over="ignore"):
        apart = mixed(h * TOP + ids[row].astype(np.uint64) + (at.astype(np.uint64) << np.uint64(20)))
    key = np.where(kind == _JUDGE, h, apart >> (np.uint64(64) - _HASH_BITS))
    # Two notes tell the rest of the table that a hot anchor has several regions and documents.
    note = np.flatnonzero(hot)
    # A removed occurrence shows that its anchor has a smaller document, which its lead already says.
    key = np.concatenate([key, h[firsts[note]], h[firsts[note]]])
    region = np.concatenate([region, np.zeros(len(note), np.uint64), np.full(len(note), np.uint64(2**32 - 1))])
    place = np.concatenate([at - batch.starts[row], np.zeros(2 * len(note), np.int64)])
    kind = np.concatenate([kind, np.full(2 * len(note), _NOTE, np.int64)])
    rest = ((place << 10) | ((region & np.uint64(255)).astype(np.int64) << 2) | kind).view(np.uint64)
    return pd.DataFrame({
        "h": pd.arrays.IntegerArray(np.concatenate([h.view(np.int64), np.zeros(2 * len(note), np.int64)]), kind != _OPEN),
        "rest": ((rest << np.uint64(32)) | (rest >> np.uint64(32))).view(np.int64),
        "mark": ((key << np.uint64(24)) | (region >> np.uint64(8))).view(np.int64),
        "id": np.concatenate([ids[row], low[note] * shared, high[note] * shared]),
    })


def _judged(sent: DataFrame, shared: int) -> DataFrame:
    """id and its removed (gone) and open occurrences."""
    doc = F.expr(f"id div {shared}")
    key = F.shiftrightunsigned("mark", 24)
    swapped = F.shiftleft("rest", 32).bitwiseOR(F.shiftrightunsigned("rest", 32))
    # One exchange serves both windows.
    rows = sent.repartition(key).withColumn("rest", swapped).select(
        key.alias("key"), (F.shiftleft(F.col("mark").bitwiseAND(F.lit(0xFFFFFF)), 8) + F.shiftright("rest", 2).bitwiseAND(F.lit(255))).alias("region"),
        "id", F.shiftright("rest", 10).alias("at"), F.col("rest").bitwiseAND(F.lit(3)).alias("kind"), "h")
    same, anchor = Window.partitionBy("key", "region"), Window.partitionBy("key")
    seen = rows.withColumn("lead", F.min(doc).over(same)).withColumns({
        "low": F.min("region").over(anchor), "high": F.max("region").over(anchor),
        "first": F.min(doc).over(anchor), "last": F.max(doc).over(anchor), "notes": (F.max(F.col("kind") == _NOTE).over(anchor)) | (F.count(F.lit(1)).over(anchor) > MANY_IN_ALL)})
    gone = (F.col("kind") == _GONE) | ((F.col("kind") == _JUDGE) & (doc > F.col("lead")))
    still = (F.col("kind") == _OPEN) | ((F.col("kind") == _JUDGE) & (F.col("low") < F.col("high")) & (F.col("first") < F.col("last")))
    hot = F.col("notes") | (F.col("kind") == _OPEN)
    kept = seen.filter(gone | still).select(
        "id", F.col("at").cast("int").alias("at"), F.when(gone, _REMOVED).otherwise(F.coalesce("h", "key") + F.when(hot, _HOT).otherwise(0)).alias("h"))
    return kept.groupBy("id").agg(F.collect_list("at").alias("ats"), F.collect_list("h").alias("hs"))


_ROUTED = "shard int, id long, at int, hot boolean, bytes binary, size int"


def _routed(window: int, gram: int, shards: int):
    """Open regions with their shard; removed stretches go along with ``size``."""
    span = window - gram

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out: list[tuple] = []
            for i, text, at, h in zip(rows["id"], rows["text"], rows["ats"], rows["hs"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                at, h = np.asarray(at, np.int64), np.asarray(h, np.int64)
                begin, end = np.maximum(at - span, 0), np.minimum(at + gram + span, len(raw))
                gone = h == _REMOVED
                starts, sizes = runs_of(covered(begin[gone], (end - begin)[gone], len(raw)))
                own = int(mixed(np.array([i], np.int64).view(np.uint64))[0] % np.uint64(shards))
                out += [(own, i, s, False, None, z) for s, z in zip(starts.tolist(), sizes.tolist(), strict=True)]
                hot = h >= _HOT
                with np.errstate(over="ignore"):
                    spread = mixed(h.view(np.uint64) + np.where(hot, np.uint64(i % 2**64) * _BASE, np.uint64(0))) % np.uint64(shards)
                for k in np.flatnonzero(~gone).tolist():
                    out.append((int(spread[k]), i, int(begin[k]), bool(hot[k]), raw[begin[k]:end[k]], 0))
            if out:
                yield pd.DataFrame(out, columns=["shard", "id", "at", "hot", "bytes", "size"])

    return each


_FOUND = "part int, key long, id long, start int, size int"


def _sorted_shard(window: int, shared: int, parts: int):
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        passed = rows[rows["size"] > 0]
        spans = [passed[["id", "at", "size"]].rename(columns={"at": "start"})]
        rows = rows[rows["size"] == 0]
        merge = pd.DataFrame({"key": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "start": np.zeros(0, np.int64)})
        if len(rows):
            text = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
            sizes = np.array([len(b) for b in rows["bytes"]], np.int64)
            starts = np.cumsum(sizes) - sizes
            order, place = suffix_array(text)
            shared_bytes = common_prefixes(text, order, place, window)
            region = np.repeat(np.arange(len(rows)), sizes)
            offset = np.arange(len(text)) - starts[region]
            valid = (sizes[region] - offset) >= window
            ids, at, hot = rows["id"].to_numpy()[region], rows["at"].to_numpy()[region] + offset, rows["hot"].to_numpy().astype(bool)[region]
            doc = np.where(valid, ids // shared, np.iinfo(np.int64).max)[order]
            new = np.concatenate([[True], shared_bytes[1:] < window])
            lead = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
            use = valid[order]
            later = order[use & (doc > lead)]
            spans.append(_joined(ids[later], at[later], window))
            first = order[use & (doc == lead)]
            first = first[hot[first]]
            if len(first):
                merge = pd.DataFrame({"key": gram_hashes(text, window)[first].view(np.int64), "id": ids[first], "start": at[first]})
        found = pd.concat(spans)
        return pd.DataFrame({
            "part": np.concatenate([np.full(len(found), -1), merge["key"].to_numpy().view(np.uint64) % np.uint64(parts)]).astype(np.int32),
            "key": np.concatenate([np.zeros(len(found), np.int64), merge["key"].to_numpy()]),
            "id": np.concatenate([found["id"].to_numpy(), merge["id"].to_numpy()]),
            "start": np.concatenate([found["start"].to_numpy(), merge["start"].to_numpy()]).astype(np.int32),
            "size": np.concatenate([found["size"].to_numpy(), np.zeros(len(merge), np.int64)]).astype(np.int32)})

    return one


def _joined(ids: np.ndarray, at: np.ndarray, window: int) -> pd.DataFrame:
    """Windows as maximal spans for each id."""
    order = np.lexsort((at, ids))
    ids, at = ids[order], at[order]
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (at[1:] > at[:-1] + window)]) if len(ids) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1 if len(first) else first
    return pd.DataFrame({"id": ids[first], "start": at[first], "size": at[last] + window - at[first]})


def _merged(window: int, shared: int):
    """The windows of a merging part that stand in a smaller document of any shard."""
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        keys, docs = rows["key"].to_numpy(), rows["id"].to_numpy() // shared
        order = np.lexsort((docs, keys))
        run, first = keys[order], docs[order]
        head = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.zeros(0, bool)
        run, first = run[head], first[head]
        lead = first[np.searchsorted(run, keys)]
        return _joined(rows["id"].to_numpy()[docs > lead], rows["start"].to_numpy()[docs > lead].astype(np.int64), window)

    return one


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for text, starts, sizes in zip(rows["text"], rows["starts"], rows["sizes"], strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            removed, spans, kept = 0, 0, raw
            if starts is not None and len(starts):
                gone = covered(np.asarray(starts, np.int64), np.asarray(sizes, np.int64), len(raw))
                removed, spans = int(gone.sum()), len(runs_of(gone)[0])
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        yield pd.DataFrame({"doc_id": rows["doc_id"], **{name: [o[k] for o in out] for k, name in enumerate(("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"))}})


def removed_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, text, starts, sizes: the stretches of bytes to remove (they may overlap)."""
    rows, shared = with_ids(docs)
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # A shard's arrays grow with its regions, which overlap: where all are open, each byte lies in so many.
    overlap = -(-2 * (2 * window - gram) // (window - gram + 2))
    shards = partitions_for(total * overlap, shard_bytes, docs.sparkSession.sparkContext.defaultParallelism)
    judged = _judged(rows.mapInPandas(_occurrences(window, gram, shared), _SENT), shared)
    routed = rows.join(judged, "id").mapInPandas(_routed(window, gram, shards), _ROUTED)
    found = routed.groupBy("shard").applyInPandas(_sorted_shard(window, shared, shards), _FOUND)
    part = F.when(F.col("part") >= 0, F.col("part")).otherwise(-1 - F.pmod(F.xxhash64("id"), F.lit(shards))).cast("int")

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return frame[["id", "start", "size"]] if key[0] < 0 else _merged(window, shared)(frame)

    spans = found.withColumn("part", part).groupBy("part").applyInPandas(merge, "id long, start int, size int")
    per_doc = spans.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    number = F.expr(f"id div {shared}")
    if shared > 1:
        number = F.when(number <= F.lit(docs.select(F.max(F.col("doc_id").cast("long"))).first()[0]), number)
    return rows.join(per_doc, "id", "left").select(number.alias("doc_id"), "text", "starts", "sizes")


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text of every document."""
    spans = removed_spans(docs, window, gram, shard_bytes)
    return spans.mapInPandas(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
