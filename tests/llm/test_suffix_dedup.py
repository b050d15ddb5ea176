"""Repeated byte strings against a table of all windows; suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from millrace.llm import queries, suffix_dedup
from millrace.llm.suffixes import common_prefixes, suffix_array
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plain(rows, window):
    order = lambda i: float("inf") if i is None else i
    raw = [(t or "").encode() for _, t in rows]
    first = {}
    for (i, _), b in zip(rows, raw, strict=True):
        for s in range(len(b) - window + 1):
            key = b[s:s + window]
            if first.get(key, float("inf")) >= order(i):
                first[key] = order(i)
    out = []
    for (i, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - window + 1):
            if first[b[s:s + window]] < order(i):
                gone[s:s + window] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), int(gone.sum()), int(((~gone[:-1]) & gone[1:]).sum() + gone[0]) if len(b) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("letters", [1, 2, 4, 250])
def test_suffixes(letters):
    rng = np.random.default_rng(letters)
    for n in (0, 1, 2, 9, 300, 1500):
        text = rng.integers(0, letters, n).astype(np.uint8)
        if n > 300:
            text[800:1000] = text[100:300]
        raw = text.tobytes()
        order, place = suffix_array(text)
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        assert place[order].tolist() == list(range(n))
        for most in (50, 7):
            got = common_prefixes(text, order, place, most)
            for k in range(1, n):
                a, b = raw[order[k - 1]:], raw[order[k]:]
                m = next((x for x in range(min(len(a), len(b), most)) if a[x] != b[x]), min(len(a), len(b), most))
                assert got[k] == m


def test_whole_table(spark):
    rows = list(pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text"]].itertuples(index=False))
    assert collected(queries.op2_suffix_dedup(spark, SMALL)) == plain(rows, 50)


@pytest.mark.parametrize("many, in_all", [(0, 20_000), (64, 20_000), (64, 1), (3, 5)])
def test_random_texts(rows_of, monkeypatch, many, in_all):
    """Low bounds deal anchors with several regions over all shards."""
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "MANY_IN_ALL", in_all)
    rng = random.Random(many)
    stock = ["".join(rng.choice("ab " if k % 2 else "abcdefghijé ") for _ in range(rng.randint(30, 200))) for k in range(25)]
    rows = []
    for i in rng.sample(range(1000), 120):
        parts = [rng.choice(stock)[rng.randint(0, 60):] if rng.random() < 0.6 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 5))]
        rows.append((i, "".join(parts)))
    assert collected(suffix_dedup.deduplicated(rows_of(rows, "doc_id long, text string"), shard_bytes=2000)) == plain(rows, 50)


def test_edges(rows_of):
    p = "".join(chr(97 + k * 7 % 26) for k in range(50))
    rows = [(5, p), (5, p), (3, "x" + p), (None, p + "y"), (None, p), (9, None), (10, ""), (12, "a" * 40_000), (13, "a" * 50), (14, "ä" * 25), (15, "xä" + "ä" * 24), (16, p[:49])]
    docs = rows_of([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, id int, at string")
    assert collected(suffix_dedup.deduplicated(docs)) == plain(rows, 50)
    assert suffix_dedup.deduplicated(rows_of([], "doc_id long, text string")).collect() == []


def test_shards_hold_what_they_are_sized_for(rows_of, monkeypatch):
    """Near copies leave all regions open, and regions overlap: a shard's bytes stay near ``shard_bytes``."""
    rng, rows, original = random.Random(2), [], suffix_dedup._sorted_shard
    for k in range(50):
        base = rng.choices("abcdefghijklmnopqrstuvwxyz", k=2000)
        for c in range(4):
            rows.append((4 * k + c, "".join(rng.choice("ABCDEFGH") if rng.random() < 1 / 60 else x for x in base)))

    def checked(*args):
        one = original(*args)

        def bounded(frame):
            assert sum(len(b) for b in frame["bytes"] if b is not None) <= 60_000, "a shard is too large"
            return one(frame)

        return bounded

    monkeypatch.setattr(suffix_dedup, "_sorted_shard", checked)
    assert collected(suffix_dedup.deduplicated(rows_of(rows, "doc_id long, text string"), shard_bytes=20_000)) == plain(rows, 50)


def test_places_far_into_a_text(rows_of):
    """A place of over 22 bits fills both halves of ``rest``."""
    rng = random.Random(7)
    passage = "".join(rng.choices("abcdefghij", k=300))
    long_text = rng.randbytes(2_200_000).hex() + passage + "z"
    got = collected(suffix_dedup.deduplicated(rows_of([(1, "y" + passage + "x"), (2, long_text)], "doc_id long, text string")))
    assert [r[:4] for r in got] == [(1, 302, 0, 0), (2, len(long_text), 300, 1)]
