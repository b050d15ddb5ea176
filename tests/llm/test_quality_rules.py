"""Quality counts, bounds and cutoffs against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import pandas as pd
import pytest

from millrace.llm import quality_rules as q, queries
from tests.llm.rows import rows_of  # noqa: F401

MIDDLE = "/root/testdata/sf0.1"
COLUMNS = "doc_id long, text string, lang string, good int, v0 string, n_words string, kept string"
LABELS = "doc_id long, quality int, toxic int, text string"


def plain(text: str | None) -> tuple:
    text = text or ""
    words = [w for w in "".join(" " if c in q.BLANK_CHARS else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(q.BLANK_CHARS)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def exact_tail(k: int, n: int, p: Fraction) -> float:
    return float(sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)))


def brute(docs: list, labels: dict, risk: float, error: float) -> tuple[dict, dict]:
    """The cutoffs by (lang, rule), and kept by position."""
    found = [(i, lang or "und", plain(t)) for i, t, lang in docs]
    failed = [m[0] < 10 or 100 * m[4] > 20 * m[0] for _, _, m in found]

    def value(rule, m):
        share = 1000 * m[q._COUNTS.index(rule.count)] // max(m[0], 1)
        return -share if rule.low else share

    held = {}
    for (i, lang, m), out in zip(found, failed, strict=True):
        if not out and i in labels:
            for r in q.RULES:
                held.setdefault((lang, r.name), {}).setdefault(i, []).append(value(r, m))
    strata = {lang for (lang, _), rows in held.items() if any(labels[i] for i in rows)}
    chosen = {}
    for (lang, name), rows in held.items():
        rule = next(r for r in q.RULES if r.name == name)
        good, bad = ([max(v) for i, v in rows.items() if labels[i] == g] for g in (1, 0))
        best = 0
        for cut in rule.steps():
            lost, caught = sum(v > cut for v in good), sum(v > cut for v in bad)
            allowed = Fraction(risk) / len(q.RULES)
            if not good or lost >= allowed * len(good) or exact_tail(lost, len(good), allowed) > error / (len(strata) * len(q.RULES)):
                break
            gain = caught * len(good) - lost * len(bad)
            if gain > best:
                best, chosen[lang, name] = gain, cut
    kept = []
    for (_, lang, m), out in zip(found, failed, strict=True):
        kept.append(not out and all(value(r, m) <= chosen.get((lang, r.name), math.inf) for r in q.RULES))
    return chosen, kept


def sample(n: int) -> tuple[list, dict]:
    rng, docs, labels = random.Random(3), [], {}
    for i in range(n):
        bad = rng.random() < 0.25
        words = ["".join(rng.choice("abcdefgéü") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 60))]
        if bad and rng.random() < 0.7:
            words = [w + rng.choice(["#", "$$", "|", ""]) for w in words]
        elif bad:
            words = [w * 2 for w in words]
        text = "".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in words)
        docs.append((i, text + ("\nsame line here\nsame line here" if rng.random() < 0.03 else ""), rng.choice(["en", "en", "de", None])))
        if rng.random() < 0.9:
            labels[i] = int(not bad)
    return docs, labels


def test_counts_of_all_kinds_of_texts():
    rng = random.Random(1)
    texts = ["", " ", "a", "a b c d e a b c d e", "x " * 30, "a\n\na\n \n a\na", "#*$%&|<> é\x0bü\x1cz y"]
    texts += ["".join(rng.choice(["a", "b", "\n", " ", " c", "d\t", "%"]) for _ in range(rng.randrange(200))) for _ in range(300)]
    found = q.counts(texts)
    assert list(found.itertuples(index=False, name=None)) == [plain(t) for t in texts]


def test_tail_is_the_exact_binomial():
    for n, p in ((1, 0.01), (50, 0.05), (400, 0.01), (900, 0.05)):
        for k in range(0, int(n * p) + 1):
            if k < n * p:
                assert q.tail(k, n, p) == pytest.approx(exact_tail(k, n, Fraction(p)), rel=1e-9)
    assert q.tail(5, 100, 0.05) == 1.0 and 0 < q.tail(10**6 - 5_000, 10**8, 0.01) < 1e-5


def test_cutoffs_and_verdicts(rows_of):  # noqa: F811
    docs, labels = sample(2_500)
    table = rows_of([(*d, 0, "x", "y", "z") for d in docs], COLUMNS)
    known = rows_of([(i, g, 0, "t") for i, g in labels.items()], LABELS)
    chosen, kept = brute(docs, labels, 0.2, 0.05)
    assert {lang for lang, _ in chosen} == {"en", "de", "und"} and len(chosen) >= 6
    tallied = q.tallies(q.measured(table), known)
    assert {(r["lang"], q.RULES[r["rule"]].name): r["cutoff"] for r in q.cutoffs(tallied, 0.2, 0.05).collect()} == chosen
    found = {r["doc_id"]: r for r in q.judged(table, known, 0.2, 0.05).collect()}
    assert [found[i]["kept"] for i, _, _ in docs] == kept
    assert all(r["kept"] == (not r["base_failed"] and not r["failed"]) for r in found.values())


def test_few_labels_prove_nothing(rows_of):  # noqa: F811
    docs, labels = sample(120)
    found = q.judged(rows_of([(*d, 0, "x", "y", "z") for d in docs], COLUMNS), rows_of([(i, g, 0, "t") for i, g in labels.items()], LABELS))
    assert all(r["kept"] != r["base_failed"] for r in found.collect())


def test_guarantee_on_fresh_documents(rows_of):  # noqa: F811
    """Cutoffs from one sample lose no more than the risk of another one's good documents."""
    docs, labels = sample(6_000)
    held = {i: g for i, g in labels.items() if i < 3_000}
    found = q.judged(rows_of([(*d, 0, "x", "y", "z") for d in docs], COLUMNS), rows_of([(i, g, 0, "t") for i, g in held.items()], LABELS), 0.1)
    fresh = [r for r in found.collect() if r["doc_id"] >= 3_000 and labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    for lang in ("en", "de", "und"):
        good = [r for r in fresh if r["lang"] == lang]
        assert sum(not r["kept"] for r in good) <= 0.1 * len(good)


def test_given_documents(spark):
    labels = pd.read_parquet(f"{MIDDLE}/labels.parquet").set_index("doc_id")["quality"]
    found = queries.op12_quality_rules(spark, MIDDLE).toPandas()
    assert list(found.columns) == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    known = found[found["doc_id"].isin(labels.index) & ~found["base_failed"]]
    good = known["doc_id"].map(labels) == 1
    assert known[good]["kept"].mean() >= 0.99 and known[~good]["kept"].mean() <= 0.6


def test_odd_rows(rows_of):  # noqa: F811
    docs = [(None, None, None), (1, "", "en"), (1, "a b c d e f g h i j", "en"), (2, "word " * 50_000, None), (2, "word " * 50_000, None), (3, "é" * 100_000, "x")]
    table = rows_of([(*d, 0, "x", "y", "z") for d in docs], COLUMNS)
    known = rows_of([(None, 1, 0, "t"), (1, None, 0, "t"), (2, 0, 0, "t"), (2, 1, 0, "t"), (99, 1, 0, "t")], LABELS)
    for labels in (known, known.limit(0)):
        got = sorted((r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_repeat_words"], r["kept"]) for r in q.judged(table, labels).collect())
        assert got == [(0, 0, 0, 0, False), (1, 0, 0, 0, False), (1, 10, 10, 0, True), (2, 50_000, 200_000, 50_000, False),
                       (2, 50_000, 200_000, 50_000, False), (3, 1, 100_000, 0, False)]
    assert q.judged(table.limit(0), known).collect() == []
