"""Collocations against counting in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pandas as pd

from millrace.llm import collocations as c, queries
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, phrase string, n long, cell int"
FOLDED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(docs) -> tuple[dict, Counter]:
    found, words = {}, Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(FOLDED)):
            parts = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(parts)
            for k in (1, 2, 3):
                for i in range(len(parts) - k + 1):
                    found.setdefault(lang or "und", Counter())[tuple(parts[i:i + k])] += 1
    return found, words


def brute(docs, top=2_000, least=10) -> list[tuple]:
    found, words = grams(docs)
    out = []
    for lang, f in found.items():
        kept = []
        for gram, a in f.items():
            if len(gram) == 1 or a < least:
                continue
            around = [n for g, n in f.items() if len(g) > len(gram) and n >= least and any(g[i:i + len(gram)] == gram for i in range(len(g)))]
            if any(100 * n >= 50 * a for n in around):
                continue
            cuts = [(1_000_000 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def test_whole_table(spark):
    frame = pd.read_parquet(f"{SMALL}/documents.parquet")
    docs = list(zip(frame["text"], frame["lang"], strict=True))
    found = queries.op13_collocation_mining(spark, SMALL)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(docs)
    assert len(want) > 150 and rows(found) == want


def sample(n: int) -> list[tuple]:
    rng = random.Random(4)
    vocabulary = ["the", "The", "of", "naïve", "ÉTÉ", "été", "x\x01", "\x1c"] + ["w%d" % i for i in range(12)]
    made = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "\x0b"]) for _ in range(rng.randrange(60)))
        made.append((i, text + "hot passage here, " * (i % 3), rng.choice(["en", "de", None]), "p", 1, 2))
    return made


def test_divided_cells_and_small_blocks(rows_of):  # noqa: F811
    """A budget far below the table: cells are divided by the second and third word, counts add up."""
    made = sample(120)
    want = brute([(r[1], r[2]) for r in made], top=50)
    for budget, chars in ((40, 200), (400, 1_000), (c.LEAVES_PER_GROUP, c.CHUNK_CHARS)):
        assert rows(c.collocations(rows_of(made, COLUMNS), top=50, leaves_per_group=budget, chunk_chars=chars)) == want


def test_counts_are_those_of_all_phrases(rows_of):  # noqa: F811
    made = sample(40)
    found, words = grams([(r[1], r[2]) for r in made])
    want = {(lang, *gram, *[None] * (3 - len(gram)), n) for lang, f in found.items() for gram, n in f.items() if n >= 2}
    got = c.counts(rows_of(made, COLUMNS), least=2, leaves_per_group=100, chunk_chars=300).collect()
    assert {(r["lang"], r["first"], r["second"], r["third"], r["n"]) for r in got if r["depth"]} == want
    assert {r["lang"]: r["n"] for r in got if not r["depth"]} == dict(words)


def test_groups_stay_within_the_budget():
    texts = [r[1] for r in sample(200)]
    leaves = c.suffixes(texts)
    found = c.cells("en", leaves, c.LEAST_CELLS)
    ones = [np.bincount(f, leaves.n, c.LEAST_CELLS).astype(int) for f in found]
    plan = c.Partition.packed(ones, 50)
    size = np.bincount(plan.of(found))
    assert plan.of(found).min() >= 0 and (plan.groups[0] < 0).any() and (plan.groups[1] < 0).any()
    assert size.max() <= 100 and len(size[size > 0]) > len(texts) / 20


def test_scores_are_exact_beyond_64_bits():
    a, left, right = 10**17 + 7, 10**18 + 9, 2 * 10**17 + 1
    frame = pd.DataFrame({"lang": ["en"], "phrase": ["a b"], "a": [a], "cuts": [[{"l": left, "r": right}]]})
    assert next(c._scores(iter([frame])))["score"][0] == 10**6 * a * a // (left * right)


def test_odd_rows(rows_of):  # noqa: F811
    made = [(None, None, None, None, None, None), (1, "", "en", "", 0, 0), (1, " \t\n.;", "en", "", 0, 0), (2, "a b " * 30_000, None, "x", 1, 1),
            (3, "A B", "x", "", 1, 1), (3, "A B", "x", "", 1, 1)]
    assert rows(c.collocations(rows_of(made, COLUMNS))) == brute([(r[1], r[2]) for r in made])
    assert rows(c.collocations(rows_of(made, COLUMNS).limit(0))) == []
