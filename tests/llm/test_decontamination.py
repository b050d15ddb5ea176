"""Benchmark passages against a search over all windows."""

from __future__ import annotations

import random
from collections import Counter
from math import log

import numpy as np
import pandas as pd

from millrace.llm import decontamination as d, queries
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def all_windows(docs, items, least=0.8):
    """The best similarity of every document and item, over all windows of the item's size."""
    names = {i: d.shingles(d.words_of(t)) for i, t in items}
    having = Counter(s for own in names.values() for s in set(own))
    weight = lambda s: log((1 + len(items)) / (1 + having[s])) + 1
    found = {}
    for doc, text in docs:
        words = d.words_of(text)
        present = set(d.shingles(words))
        for item, own in names.items():
            n = len(d.words_of(dict(items)[item]))
            if not own or (n >= d.SHINGLE and not present & set(own)):
                continue
            best = max((d.similarity(Counter(d.shingles(words[s:s + n])), Counter(own), weight) for s in range(len(words) - n + 1)), default=0)
            if best >= least:
                found[doc, item] = round(best, 9)
    return found


def test_whole_table(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text"]].itertuples(index=False)
    items = list(pd.read_parquet(f"{SMALL}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False))
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in queries.op7_decontamination(spark, SMALL).collect()}
    assert got and got == all_windows(list(docs), items)


def test_planted_and_edges(rows_of):
    rng = random.Random(2)
    words = ["w%d" % i for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(20, 50)))) for i in range(30)] + [(100, "tiny item here"), (101, None), (102, ""), (103, "?!")]
    docs, noise = [], lambda k: " ".join(rng.choices(words, k=k))
    for i in range(60):
        body = dict(items)[i % 30].split()
        if i >= 30:  # one word changed at the end: near, and for long items still over the bound
            body[-1] = "changed"
        docs.append((i, noise(80) + "\n" + "  ".join(body).upper() + ", " + noise(40)))
    docs += [(200, None), (201, ""), (202, "a tiny ITEM here."), (203, noise(20_000)), (None, items[3][1])]
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9)
           for r in d.matches(rows_of([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string"),
                              rows_of([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"), items_at_once=7).collect()}
    assert got == all_windows(docs, items)
    assert (202, 100) in got and (None, 3) in got and all((i, i) in got for i in range(30))


def test_hamming_blocks_find_all():
    rng = np.random.default_rng(6)
    prints = rng.integers(0, 2**63, 500).astype(np.uint64)
    index = d.HammingBlocks(prints, 20)
    for _ in range(50):
        query = prints[rng.integers(500)] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 24)), replace=False)))
        want = {i for i, p in enumerate(prints) if (int(p) ^ int(query)).bit_count() <= 20}
        assert set(index.search(query).tolist()) == want


def test_empty_tables(rows_of):
    docs, items = rows_of([(1, "a b")], "doc_id long, text string"), rows_of([(1, "a b")], "item_id long, text string")
    assert d.matches(docs.limit(0), items).collect() == [] and d.matches(docs, items.limit(0)).collect() == []


def test_documents_shorter_than_the_item(rows_of):
    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(20)] + [(50, "a b c d e f g"), (51, "a b c")]
    docs = [(100 * k + i, " ".join(t.split()[:40 - k])) for i, t in items[:20] for k in (1, 2, 5, 8, 20)]
    docs += [(i, " ".join(t.split()[1:39])) for i, t in items[:20]] + [(9_000, "a b c d e f"), (9_001, "a b"), (9_002, "b c d e"), (9_003, "")]
    names = {i: Counter(d.shingles(d.words_of(t))) for i, t in items}
    having = Counter(s for own in names.values() for s in own)
    weight = lambda s: log((1 + len(items)) / (1 + having[s])) + 1
    want = all_windows(docs, items)
    for doc, text in docs:
        for item, t in items:
            own = Counter(d.shingles(d.words_of(text)))
            value = d.similarity(own, names[item], weight)
            if len(d.words_of(text)) < len(d.words_of(t)) and value >= 0.8:
                want[doc, item] = round(value, 9)
    tables = rows_of(docs, "doc_id long, text string"), rows_of(items, "item_id long, text string")
    found = d.matches(*tables).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in found} == want
    assert all((100 * k + i, i) in want for i in range(20) for k in (1, 2, 5)) and all((i, i) in want for i in range(20))
    assert {r["n_words"] for r in found if r["doc_id"] // 100 == 2} == {38}
    assert {r["doc_id"] for r in d.without_matches(*tables).collect()} == {i for i, _ in docs} - {i for i, _ in want}
