"""The block-max index against all similarities, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pytest

from millrace.llm import queries, toxicity
from millrace.llm.blockmax import BlockMaxIndex
from millrace.llm.common import table
from tests.llm.rows import rows_of  # noqa: F401


@pytest.mark.parametrize("block", [1, 7, 64])
def test_neighbours_are_exact(block):
    rng = np.random.default_rng(block)
    vectors = rng.random((300, 40)) * (rng.random((300, 40)) < 0.15)
    vectors[5] = vectors[6]
    norms = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0).astype(np.float32)
    queries_ = np.concatenate([vectors[:50], np.zeros((1, 40), np.float32)])
    near, places = BlockMaxIndex(vectors, block).search(queries_, 8)
    scores = np.round(queries_ @ vectors.T, 5)
    for q in range(len(queries_)):
        want = sorted(range(300), key=lambda i: (-scores[q, i], i))[:8]
        assert np.allclose(near[q], scores[q, want], atol=1e-4)
        assert np.allclose(scores[q, places[q]], near[q], atol=1e-4) and len(set(places[q])) == 8
    assert BlockMaxIndex(np.zeros((0, 40), np.float32)).search(queries_, 3)[0].shape == (51, 0)


def planted(rng, n):
    """Clean words, and toxic ones of two languages; one language inflects its stem."""
    clean = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = rng.choices(clean, k=rng.randint(20, 120))
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["Idiot,", "scum", "grobi" + rng.choice("abcdefgh")]))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows_and_edges(rows_of, spark):
    rng = random.Random(3)
    rows, labels = planted(rng, 1500)
    odd = [(None, None, None), (5001, None, "x"), (5002, "", "x"), (5003, "scum " * 40_000, "x"), (5003, "scum " * 40_000, "x")]
    docs = rows_of(rows + odd, "doc_id long, text string, score string")
    known = rows_of(labels + [(5001, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    got = {}
    for r in toxicity.scored(docs, model).select("*", toxicity.held_out().alias("h")).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(odd)
    held = [(got[i][0], t) for i, _, t in labels if got[i][0]["h"]]
    assert len(held) > 200 and sum(r["predicted"] == t for r, t in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for own in got.values() for r in own)
    assert got[5001][0]["score"] == got[5002][0]["score"] == got[None][0]["score"] < 0.3
    assert [r["predicted"] for r in got[5003]] == [1, 1] and got[5003][0]["evidence"]
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, own in got.items() if not own[0]["predicted"]}


def test_never_learns_from_held_out_rows(rows_of):
    """Labels of the held-out rows may say anything."""
    rng = random.Random(4)
    rows, labels = planted(rng, 400)
    docs = rows_of(rows, "doc_id long, text string, lang string")
    right = rows_of(labels, "doc_id long, quality int, toxic int")
    held = {r["doc_id"] for r in docs.filter(toxicity.held_out()).collect()}
    wrong = rows_of([(i, q, 1 - t if i in held else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.scored(docs, toxicity.fit(docs, x)).collect()) for x in (right, wrong)]
    assert scores[0] == scores[1]


def test_nothing_to_learn(rows_of, spark):
    docs = rows_of([(1, "a", "x")], "doc_id long, text string, lang string")
    none = rows_of([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.scored(docs, toxicity.fit(docs, none)).collect()] == [0.0]
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), none)).collect() == []


def test_given_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    rows = [r for r in queries.op5_toxicity(spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    clean = [r for r in rows if labels[r["doc_id"]] == 0]
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    assert sum(r["predicted"] for r in rows if labels[r["doc_id"]] == 1) >= 5


def test_every_word_and_example_counts(rows_of):
    """Neighbours equal a dense cosine over all features; no example and no document with a known word is left out."""
    rng = random.Random(9)
    rows, labels = planted(rng, 240)
    docs = rows_of(rows, "doc_id long, text string, lang string")
    model = toxicity.fit(docs, rows_of(labels, "doc_id long, quality int, toxic int"))
    chosen = [r["__id"] for r in toxicity._chosen(rows_of(labels, "doc_id long, quality int, toxic int"), toxicity.Settings()).filter("role = 0").collect()]
    seen = {f for i in chosen for f in toxicity.features(toxicity.word_counts(rows[i][1]))}
    assert set(model.vocabulary.tolist()) == set(map(toxicity.term_hash, seen)) and set(model.ids) == set(chosen)
    assert (model.weights > 0).all()
    texts = {i: t for i, t, _ in rows}
    examples = model.vectors([texts[i] for i in model.ids]).toarray()
    for r in toxicity.scored(docs, model).collect():
        own = model.vectors([texts[r["doc_id"]]]).toarray()[0]
        scores = np.sort(examples @ own)[::-1]
        assert len(r["evidence"]) == 3 and np.allclose(r["similarity"], scores[:3], atol=1e-4)


def test_calibration_rows_stay_with_the_executors(rows_of, monkeypatch):
    """The driver searches no neighbours; what it calibrates with are two numbers a row."""
    rows, labels = planted(random.Random(6), 600)
    searched = []
    monkeypatch.setattr(BlockMaxIndex, "search", lambda *a: searched.append(a))
    model = toxicity.fit(rows_of(rows, "doc_id long, text string, lang string"), rows_of(labels, "doc_id long, quality int, toxic int"))
    assert not searched and len(model.cuts) and (np.diff(model.levels) >= 0).all()


def test_beginnings_are_hashed_once(monkeypatch):
    """Counts equal those of ``features``, in whole and in a vocabulary, and work follows the different beginnings, not the words."""
    rng, hashed = random.Random(13), []
    heads = ["Abcde", "abcd", "\u00e9t\u00e9s\u00fc", "\U0001f600wxyz", "xyz", "\u0130stan"]
    texts = [" ".join(rng.choice(heads) + "-" * (k % 3 == 0) + rng.choice(heads) + str(k + 7 * i) for k in range(600)) for i in range(20)] + ["", None, "a\udc80b _ 12345"]
    want = [{toxicity.term_hash(f): n for f, n in toxicity.features(toxicity.word_counts(t)).items()} for t in texts]
    vocabulary = np.sort(np.array(sorted({h for own in want for h in own})[::3], np.uint64))
    original = toxicity.term_hash
    monkeypatch.setattr(toxicity, "term_hash", lambda term: (hashed.append(term), original(term))[1])
    text, term, n = toxicity.occurrences(texts)
    got = [{} for _ in texts]
    for i, h, k in zip(text.tolist(), term.tolist(), n.tolist(), strict=True):
        got[i][h] = k
    assert got == want and len(hashed) < 200
    model = toxicity.Model(vocabulary, np.ones(len(vocabulary)), None, None, [], 0.0, None, None, toxicity.Settings())
    rows = model.vectors(texts)
    known = set(vocabulary.tolist())
    for i, own in enumerate(want):
        at, data = rows.at[rows.ends[i]:rows.ends[i + 1]], rows.data[rows.ends[i]:rows.ends[i + 1]]
        counts = np.array([own[h] for h in vocabulary[at].tolist()])
        assert set(vocabulary[at].tolist()) == known & set(own)
        assert not len(at) or np.allclose(data, (1 + np.log(counts)) / np.sqrt(((1 + np.log(counts)) ** 2).sum()), atol=1e-5)
