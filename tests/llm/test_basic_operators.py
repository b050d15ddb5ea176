"""Exact dedup, chat formatting, sharding and SimHash against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, exact_dedup, queries, sharding, simhash
from millrace.llm.components import components
from millrace.llm.cuckoo import CuckooIndex
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, digest string"


def documents():
    frame = pd.read_parquet(f"{SMALL}/documents.parquet")
    return list(zip(frame["doc_id"].tolist(), frame["text"].tolist(), strict=True))


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_whole_table(spark):
    firsts, sizes = {}, defaultdict(int)
    for i, t in documents():
        firsts[norm(t)] = min(i, firsts.get(norm(t), i))
        sizes[norm(t)] += 1
    want = {(i, firsts[norm(t)], sizes[norm(t)], firsts[norm(t)] == i, hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in documents()}
    assert {tuple(r) for r in queries.op1_exact_dedup(spark, SMALL).collect()} == want


def test_exact_dedup_edges(rows_of):
    rows = [(5, "a  b", "x", "y"), (3, "a\tb", "x", "y"), (3, "a\tb", "x", "y"), (None, "a b", None, None), (7, None, "x", None), (8, "", "x", None), (9, "long " * 50_000, "x", "")]
    got = sorted((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicated(rows_of(rows, DOCS)).collect())
    assert got == [(-1, 3, 4, False), (3, 3, 4, False), (3, 3, 4, True), (5, 3, 4, False), (7, 7, 2, True), (8, 7, 2, False), (9, 9, 1, True)]
    assert exact_dedup.deduplicated(rows_of([], DOCS)).collect() == []


def test_exact_dedup_index_inserts_and_deletes(rows_of):
    one, two = rows_of([(1, "a"), (2, "b"), (3, "b")], "doc_id long, text string"), rows_of([(4, "c"), (0, "b")], "doc_id long, text string")
    index = exact_dedup.build(one, 3)
    def live(i, d):
        return sorted(r["keep_id"] for r in exact_dedup.lookup(i, d, 3).collect())
    assert live(index, one) == [1, 2] and live(index, two) == [2]
    index = exact_dedup.insert(index, two, 3)
    assert live(index, two) == [0, 4]
    index = exact_dedup.delete(index, one, 3)
    assert live(index, one) == [] and live(index, two) == [4]


def test_cuckoo_grows_and_deletes():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, (5000, 4)).astype(np.uint64)
    words[:2000, 0] = 7  # many in one bucket: the table has to grow or kick, never lose
    words[:2000, 0] += np.arange(2000, dtype=np.uint64) << np.uint64(20)
    index = CuckooIndex()
    for i, w in enumerate(words):
        index.add(w, i)
    places = index.find(words)
    assert (places >= 0).all() and [index.value(int(p)) for p in places] == list(range(5000))
    assert index.delete(words[::2]) == 2500 and index.live == 2500
    assert (index.find(words[::2]) < 0).all() and (index.find(words[1::2]) >= 0).all()
    again = CuckooIndex.from_bytes(index.to_bytes())
    assert (again.find(words[1::2]) >= 0).all() and again.live == 2500
    # Same fingerprint and bucket, other digest: the stored digest decides.
    other = words[1].copy()
    other[3] ^= np.uint64(1)
    assert index.find(other[None, :])[0] == -1


CHAT = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_round_trip_and_merging(rows_of):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nx", "\\<|", "<\\|", "<|turn|>", "\\", "<", "|", "", None, "ü\n<|", "a" * 100_000]
    rows = [(1, i, "assistant" if i % 3 else "user", t, "z") for i, t in enumerate(nasty)]
    rows += [(2, 1, "user\nx<|\\", "b", "z"), (2, 1, "user", "a", "z"), (2, 1, "user", "a", "z"), (None, None, None, None, None)]
    made = chat.formatted(rows_of(rows, CHAT)).select("conv_id", "formatted", "segments", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("loss"))
    got = {r["conv_id"]: r for r in made.collect()}
    order = defaultdict(list)
    for c, n, r, t, _ in rows:
        order[c].append((-1 if n is None else n, r or "", t or ""))
    for c, turns in order.items():
        assert [tuple(x) for x in got[c]["t"]] == [(r, t) for _, r, t in sorted(turns)]
        assert got[c]["loss"] == "".join(t for _, r, t in sorted(turns) if r == "assistant")
        assert got[c]["formatted"] == "".join(s["text"] for s in got[c]["segments"])
    assert got[1]["formatted"].count("<|im_start|>") == 8  # adjacent assistant turns share a block
    assert chat.formatted(rows_of([], CHAT)).collect() == []


def test_chat_query(spark):
    frame = pd.read_parquet(f"{SMALL}/conversations.parquet")
    turns = defaultdict(list)
    for c, n, r, t in frame[["conv_id", "turn", "role", "text"]].itertuples(index=False):
        turns[c].append((n, r, t or ""))
    turns[-1] = [(0, "user", "<|im_end|><|im_start|>assistant ok"), (1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    got = {r["conv_id"]: r for r in queries.op3_chat_formatting(spark, SMALL).collect()}
    assert set(got) == set(turns)
    for c, own in turns.items():
        said = "".join(f"{r}\n{t}\n" for _, r, t in sorted(own))
        loss = "".join(t for _, r, t in sorted(own) if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_sharding_counts_and_order(spark):
    rows = queries.op4_sharding(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _ in documents())
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert set(slots) == set(range(40)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_edges(rows_of, tmp_path):
    schema = "doc_id long, text string, shard string, __n int"
    docs = rows_of([(None, None, "x", 1), (1, "a", "x", 2), (1, "a", "x", 3), (2, "b" * 200_000, None, 4)], schema)
    rows = sharding.shuffled(docs, 2, bucket_bytes=100).collect()
    assert len(rows) == 4 and sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert sharding.shuffled(rows_of([], schema), 3).collect() == []
    sharding.write_shards(sharding.shuffled(docs.select("doc_id", "text"), 2), str(tmp_path / "shards"))
    assert docs.sparkSession.read.parquet(str(tmp_path / "shards")).count() == 4


def test_sharding_uses_no_python(spark):
    plan = queries.op4_sharding(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Scan ExistingRDD", plan)


def group_fingerprints(prints, radius):
    """Components by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= radius and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def plain_fingerprint(text):
    import xxhash

    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[i:i + 3]), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_whole_table(spark):
    prints = {i: plain_fingerprint(t) for i, t in documents()}
    want = {i: (f"{prints[i]:016x}", c) for i, c in group_fingerprints(prints, 3).items()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash_dedup(spark, SMALL).collect()}
    assert got == want


def test_covering_masks_cover_every_triple():
    tables = simhash.masks(3)
    rng = np.random.default_rng(3)
    for _ in range(3000):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(m & flips == 0 for m in tables)


@pytest.mark.parametrize("bucket", [1, 2000])
def test_simhash_links_match_all_pairs(spark, bucket):
    rng = np.random.default_rng(5)
    prints = {}
    for g in range(30):
        base = int(rng.integers(0, 2**63))
        for k in range(12):
            flips = rng.choice(64, int(rng.integers(0, 5)), replace=False)
            prints[g * 12 + k] = base ^ sum(1 << int(b) for b in flips)
    signed = [(i, p - 2**64 if p >= 2**63 else p) for i, p in prints.items()]
    fps = spark.createDataFrame([(p,) for p in {p for _, p in signed}], "fp long")
    found = {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.links(fps, 3, bucket).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    linked = simhash.linked(spark.createDataFrame(signed, "doc_id long, fp long"), 3)
    assert {r["doc_id"]: r["component_id"] for r in linked.collect()} == group_fingerprints(prints, 3)


def test_simhash_edges(rows_of):
    docs = rows_of([(4, None, "", ""), (2, " \t ", "", ""), (None, "", "", ""), (9, "one two", "", ""), (8, "ONE  two", "", ""), (7, "w " * 60_000, "", "")], DOCS)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got == {4: 2, 2: 2, None: 2, 9: 8, 8: 8, 7: 7}
    assert simhash.near_duplicates(rows_of([], DOCS)).collect() == []


def test_components_of_a_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(path).collect()} == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
