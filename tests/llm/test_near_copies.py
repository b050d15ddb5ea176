"""Near copies against the Jaccard similarity of all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pandas as pd

import corpus_pipeline
from millrace.llm import near_copies, simhash
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string"


def brute(texts: dict) -> set:
    """The smallest id of each group of texts of similarity 0.8 or more."""
    sets, group = {i: near_copies.shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        if near_copies.jaccard(sets[a], sets[b]) >= 0.8:
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    return {i for i in texts if root(i) == i}


def kept(spark, rows_of, texts: dict) -> set:
    return {r["doc_id"] for r in corpus_pipeline.keep_one_of_near(spark, rows_of([(i, t, "x") for i, t in texts.items()], COLUMNS), SMALL).collect()}


def test_scattered_substitutions(spark, rows_of):
    rng, texts = random.Random(5), {}
    for k in range(120):
        words = ["w%d" % rng.randrange(5000) for _ in range(rng.randint(100, 500))]
        texts[2 * k] = " ".join(words)
        for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.uniform(0.005, 0.03)))):
            words[at] = "other%d" % rng.randrange(1000)
        texts[2 * k + 1] = " ".join(words)
    want = brute(texts)
    assert 130 < len(want) < 230 and kept(spark, rows_of, texts) == want


def test_copies_of_one_that_are_not_alike_themselves(spark, rows_of):
    rng, texts = random.Random(8), {}
    base = ["w%d" % i for i in range(300)]
    for k in range(60):
        own = list(base)
        for at in rng.sample(range(300), 5):
            own[at] = "other%d" % rng.randrange(10**6)
        texts[k] = " ".join(own)
    texts[100] = " ".join(base)
    assert kept(spark, rows_of, texts) == brute(texts) == {0}


def test_a_common_passage_forms_few_pairs(spark, rows_of, monkeypatch):
    """2,000 different documents around 150 words they all have, at three shares of it, and some near copies among them."""
    rng, texts, compared = random.Random(3), {}, []
    common = ["c%d" % i for i in range(150)]
    for k in range(1960):
        own = ["w%d" % rng.randrange(10**6) for _ in range((105, 60, 40)[k % 3])]
        at = rng.randrange(len(own))
        texts[k] = " ".join(own[:at] + common + own[at:])
    for k in range(40):
        words = texts[40 * k].split()
        words[rng.randrange(len(words))] = "changed"
        texts[2000 + k] = " ".join(words)
    similar = near_copies._similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(near_copies, "_similar", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_copies.linked(rows_of([(i, t, "x") for i, t in texts.items()], COLUMNS)).collect()}
    assert got == {i: 40 * (i - 2000) if i >= 2000 else i for i in texts}
    assert sum(compared) < 20 * len(texts)


def test_changed_copies_of_one_text_form_few_pairs(spark, rows_of, monkeypatch):
    """360 copies of one text, a sixth of them changed too much to be near copies, and near copies of some of these."""
    rng, texts, compared = random.Random(12), {}, []
    base = ["w%d" % i for i in range(150)]
    for k in range(360):
        own = list(base)
        for at in rng.sample(range(150), rng.randint(4, 5) if k % 6 == 5 else rng.randint(1, 3)):
            own[at] = "other%d" % rng.randrange(10**6)
        texts[k] = " ".join(own)
    for k in range(20):
        words = texts[18 * k + 5].split()
        words[rng.randrange(150)] = "changed%d" % k
        texts[1000 + k] = " ".join(words)
    similar = near_copies._similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(near_copies, "_similar", counted)
    want = brute(texts)
    assert 50 < len(want) < 70 and kept(spark, rows_of, texts) == want
    assert sum(compared) < 10 * len(texts)


def test_recall_at_the_limit(spark, rows_of):
    """Pairs of similarity 0.80 to 0.85: nearly all are found, and nothing below."""
    rng, texts = random.Random(9), {}
    for k in range(300):
        words = ["w%d" % rng.randrange(10**6) for _ in range(300)]
        texts[2 * k] = " ".join(words)
        for at in rng.sample(range(300), rng.randint(4, 8)):
            words[at] = "other%d" % rng.randrange(10**6)
        texts[2 * k + 1] = " ".join(words)
    sets = {i: near_copies.shingles(t) for i, t in texts.items()}
    near = {i for i in range(0, 600, 2) if 0.8 <= near_copies.jaccard(sets[i], sets[i + 1]) < 0.85}
    below = {i for i in range(0, 600, 2) if near_copies.jaccard(sets[i], sets[i + 1]) < 0.8}
    got = {r["doc_id"]: r["component_id"] for r in near_copies.linked(rows_of([(i, t, "x") for i, t in texts.items()], COLUMNS)).collect()}
    assert len(near) > 50 and len(below) > 30
    assert sum(got[i + 1] == i for i in near) >= 0.99 * len(near) and not any(got[i + 1] == i for i in below)


def test_simhash_links_come_first(spark, rows_of, monkeypatch):
    """The stage goes through SimHash: its links within 3 bits are compared first, and what they join is not compared again."""
    rng, texts, compared = random.Random(11), {}, []
    for k in range(4):
        words = ["w%d" % rng.randrange(10**6) for _ in range(900)]
        for c in range(25):
            own = list(words)
            own[rng.randrange(900)] = "other%d" % c
            texts[100 * k + c] = " ".join(own)
    similar = near_copies._similar

    def counted(pairs, *rest):
        compared.append({(r["a"], r["b"]) for r in pairs.collect()})
        return similar(pairs, *rest)

    monkeypatch.setattr(near_copies, "_similar", counted)
    assert kept(spark, rows_of, texts) == {0, 100, 200, 300}
    prints = {near_copies._node(near_copies._hashes(near_copies.shingles(t))): simhash.fingerprint(t) for t in texts.values()}
    within = {(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 3}
    group = {n: n for n in prints}
    for _ in prints:
        for a, b in compared[0]:
            group[a] = group[b] = min(group[a], group[b])
    assert len(within) > 500 and compared[0] <= within and all(group[a] == group[b] for a, b in within)
    assert not any(group[a] == group[b] for later in compared[1:] for a, b in later)


def test_whole_table(spark, rows_of):
    texts = dict(pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text"]].itertuples(index=False))
    assert kept(spark, rows_of, texts) == brute(texts)


def test_edges(spark, rows_of):
    rows = [(None, "a b", "x"), (1, "a b", "x"), (1, "quite another text of more words", "x"), (2, "A  b", "x"), (3, None, "x"), (4, " ", "x")]
    got = [r["doc_id"] for r in corpus_pipeline.keep_one_of_near(spark, rows_of(rows, COLUMNS), SMALL).collect()]
    assert sorted(got, key=lambda i: i or 0) == [None, 1, 1, 3]
    assert corpus_pipeline.keep_one_of_near(spark, rows_of(rows, COLUMNS).limit(0), SMALL).collect() == []
