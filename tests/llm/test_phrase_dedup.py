"""Repeated word passages against a table of all windows."""

from __future__ import annotations

import hashlib
import random
import re

import pandas as pd
import pytest

from millrace.llm import phrase_dedup, queries
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plain(rows, window):
    """(doc_id, n_words, n_removed, sha) with every window of every document in one dictionary."""
    order = lambda i: float("inf") if i is None else i
    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in rows]
    first = {}
    for (i, _), words in zip(rows, split, strict=True):
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for (i, _), words in zip(rows, split, strict=True):
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < order(i):
                gone.update(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = list(pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text"]].itertuples(index=False))
    assert collected(queries.op8_phrase_dedup(spark, SMALL)) == plain(rows, 13)


@pytest.mark.parametrize("letters", [2, 6, 200])
def test_random_texts(rows_of, letters):
    rng = random.Random(letters)
    stock = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) if letters > 9 else rng.choice("abcdef"[:letters]) for _ in range(rng.randint(5, 60))) for _ in range(20)]
    rows = []
    for i in rng.sample(range(1000), 120):
        parts = [rng.choice(stock)[rng.randint(0, 20):] if rng.random() < 0.6 else " ".join(str(rng.randrange(letters)) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(parts)))
    assert collected(phrase_dedup.deduplicated(rows_of(rows, "doc_id long, text string"))) == plain(rows, 13)


def test_edges(rows_of):
    passage = " ".join(f"w{k}" for k in range(13))
    rows = [(5, passage), (5, passage), (3, "x " + passage), (None, passage + " y"), (None, passage), (9, None), (10, ""), (11, " \n"), (12, "a " * 30_000), (13, "a " * 13), (14, "ä\x85ö  " * 20), (15, "ä\x85ö  " * 20)]
    docs = rows_of([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, id int, hs string")
    assert collected(phrase_dedup.deduplicated(docs)) == plain(rows, 13)
    assert phrase_dedup.deduplicated(rows_of([], "doc_id long, text string")).collect() == []
