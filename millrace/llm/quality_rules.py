"""Quality rules whose cutoffs keep the loss of good documents below a proven bound.

Each document gets counts: words, code points in words, symbols, repeated lines, and words in repeated
windows. Two rules are fixed (``base_failed``). The others (``RULES``) reject where a value, in thousandths
of a word, lies beyond a cutoff, and the cutoff is chosen for each stratum (language) on labelled documents:

- the cutoffs to try are a fixed ladder from mild to strict, so all labelled documents are holdouts;
- a rule may lose at most ``risk / len(RULES)`` of a stratum's good documents, all rules together ``risk``;
- a cutoff is proven if k of n good holdouts or fewer lie beyond it with a binomial probability
  P(X <= k | n, allowed risk) of at most ``error / (strata * rules)``, the exact (Clopper-Pearson) bound
  with a Bonferroni correction. The ladder is climbed while cutoffs are proven, so its steps need none;
- of the proven cutoffs the one counts with the largest difference between the share of bad and of good
  holdouts beyond it, of equal ones the mildest. No cutoff at all is the mildest.

With probability ``1 - error`` no stratum loses more than ``risk`` of its good documents to the rules. The
bound takes labelled documents as drawn independently; copies of one text weaken it. A stratum with few
labels proves nothing and rejects nothing.

The ladder's tallies have one row per stratum, rule and step; no document is gathered. Cutoffs meet the
documents through a table of one row per stratum, which Spark broadcasts if it is small.

Cases: null texts have no words and fail the base rules; a null language is the stratum ``und``; labelled
ids without a document, null labels and null ids do not count; an id with labels of both kinds is bad; rows
of one id count once, by their largest values; empty tables give an empty result, or no cutoffs. Extra
columns are ignored. Very long texts are counted alone, others in chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import text_or_empty, written

WINDOW = 5
LEAST_WORDS = 10
REPEATED_PERCENT = 20
RISK = 0.05
ERROR = 0.05
CHUNK_CHARS = 4 << 20
SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\x0b\x0c\r"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects where 1000 * count / words is above a cutoff, or below it if ``low``."""

    name: str
    count: str
    ladder: tuple[int, ...]
    low: bool = False

    def value(self) -> Column:
        """Whole thousandths, negative for a low rule, so that larger is worse."""
        share = F.expr(f"1000 * {self.count} div greatest(n_words, 1)")
        return -share if self.low else share

    def steps(self) -> list[int]:
        return [-c if self.low else c for c in self.ladder]


RULES = (
    Rule("symbols", "n_symbols", (2000, 1000, 700, 500, 400, 300, 200, 150, 100, 70, 50, 30, 20, 10)),
    Rule("long words", "word_chars", (12000, 11000, 10000, 9000, 8500, 8000, 7500, 7000, 6750, 6500, 6250, 6000)),
    Rule("short words", "word_chars", (1500, 2000, 2500, 3000, 3250, 3500, 3750, 4000, 4250, 4500), low=True),
    Rule("repeated lines", "n_dup_lines", (100, 70, 50, 40, 30, 20, 10)),
    Rule("repeated words", "n_repeat_words", (180, 160, 140, 120, 100, 80, 60, 40)),
)


def repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """For each text the words that lie in a window of ``WINDOW`` words found twice or more in it."""
    sizes = np.array([len(w) for w in words], np.int64)
    text = np.repeat(np.arange(len(words)), sizes)
    if len(text) <= WINDOW:
        return np.zeros(len(words), np.int64)
    flat = np.empty(len(text), object)
    flat[:] = [w for own in words for w in own]
    one = pd.factorize(flat)[0]
    # Numbers of windows of two, four and five words, by pairs of numbers of shorter ones.
    two = _paired(one[:-1], one[1:])
    four = _paired(two[:-2], two[2:])
    five = _paired(four[:-1], one[4:])
    start = np.flatnonzero(text[:1 - WINDOW] == text[WINDOW - 1:])
    window = _paired(five[start], text[start])
    start = start[np.bincount(window)[window] > 1]
    change = np.bincount(start, minlength=len(text) + 1) - np.bincount(start + WINDOW, minlength=len(text) + 1)
    covered = np.cumsum(change)[:len(text)] > 0
    return np.bincount(text[covered], minlength=len(words))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return pd.factorize(a * (b.max() + 1) + b)[0] if len(a) else a


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def counts(texts: list[str]) -> pd.DataFrame:
    """The counts of each text."""
    raw = [t.encode() for t in texts]
    words = [r.split() for r in raw]
    lines = [[line for line in r.split(b"\n") if not line.isspace() and line] for r in raw]
    return pd.DataFrame({
        "n_words": [len(w) for w in words],
        "word_chars": [len(t) - sum(map(t.count, BLANK_CHARS)) for t in texts],
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
        "n_dup_lines": [len(own) - len(set(own)) for own in lines],
        "n_repeat_words": repeat_words(words),
    }, dtype="int64")


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = pd.concat([counts(chunk) for chunk in _chunks(list(rows["text"]))], ignore_index=True)
        yield pd.concat([rows[["doc_id", "lang"]].reset_index(drop=True), found], axis=1)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the counts, and base_failed."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInPandas(_measure, ", ".join([f"doc_id {kind}", "lang string", *[f"{c} long" for c in _COUNTS]]))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable; 1 from its mean on, where no test passes."""
    if k >= n * p:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    # Below the mean the terms fall, so those left out add nothing a double could hold.
    while term > total * 1e-18:
        total += term
        if k == 0:
            break
        term *= k * (1 - p) / ((n - k + 1) * p)
        k -= 1
    return total


def _proven(allowed: float, level: float):
    def prove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            passed = [tail(int(k), int(n), allowed) <= level for k, n in zip(rows["good_lost"], rows["good"], strict=True)]
            yield rows[passed]

    return prove


def tallies(measures: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """lang, rule, step, cutoff, good, bad, good_lost, bad_caught: labelled documents beyond each cutoff."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") == 1).alias("good"))
    fit = measures.filter("not base_failed and doc_id is not null")
    values = [F.max(r.value()).alias(f"v{i}") for i, r in enumerate(rules)]
    held = fit.join(known, F.col("doc_id") == F.col("_id")).groupBy("doc_id", "lang", "good").agg(*values)
    # A value beyond a step is beyond all milder ones: its level is the number of steps it passes.
    levels = F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule"), sum(((F.col(f"v{i}") > c).cast("int") for c in r.steps()), F.lit(0)).alias("level")) for i, r in enumerate(rules)]))
    by_level = held.select("lang", "good", levels.alias("at")).groupBy("lang", "at.rule", "at.level").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    tried = F.array(*[F.array(*[F.lit(c) for c in r.steps()]) for r in rules])
    ladder = by_level.groupBy("lang", "rule").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.collect_list(F.struct("level", "good", "bad")).alias("levels"))
    # Values rise with the cutoff, so the stricter of two steps loses no less.
    steps = ladder.select("*", F.posexplode(F.get(tried, F.col("rule"))).alias("step", "cutoff"))
    width = F.size(F.get(tried, F.col("rule")))

    def beyond(name: str) -> Column:
        # Beyond step s (0: mildest of w) lie the levels of at least w - s steps.
        return F.aggregate("levels", F.lit(0).cast("long"), lambda t, x: t + F.when(x["level"] >= width - F.col("step"), x[name]).otherwise(0))

    return steps.select("lang", "rule", "step", "cutoff", "good", "bad", beyond("good").alias("good_lost"), beyond("bad").alias("bad_caught"))


def cutoffs(tallied: DataFrame, risk: float = RISK, error: float = ERROR, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """lang, rule, cutoff: the chosen cutoffs; a rule without one has no row."""
    strata = tallied.filter("good > 0").select("lang").distinct().count()
    if not strata:
        return tallied.select("lang", "rule", "cutoff").limit(0)
    proven = tallied.filter("good > 0").mapInPandas(_proven(risk / len(rules), error / (strata * len(rules))), tallied.schema)
    wide = "cast({} as decimal(19,0))"
    gain = F.expr(f"{wide.format('bad_caught')} * {wide.format('good')} - {wide.format('good_lost')} * {wide.format('bad')}")
    best = Window.partitionBy("lang", "rule").orderBy(F.desc("gain"), "step")
    return proven.withColumn("gain", gain).filter("gain > 0").withColumn("place", F.row_number().over(best)).filter("place = 1").select("lang", "rule", "cutoff")


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, lang, the counts, base_failed, failed (names of the rules), kept."""
    measures = written(measured(docs), "quality-counts")
    chosen = cutoffs(written(tallies(measures, labels, rules), "quality-tallies"), risk, error, rules)
    of_stratum = [F.max(F.when(F.col("rule") == i, F.col("cutoff"))).alias(f"c{i}") for i in range(len(rules))]
    per_stratum = written(chosen.groupBy(F.col("lang").alias("_lang")).agg(*of_stratum), "quality-cutoffs")
    failed = F.filter(F.array(*[F.when(r.value() > F.col(f"c{i}"), F.lit(r.name)) for i, r in enumerate(rules)]), lambda x: x.isNotNull())
    joined = measures.join(per_stratum, F.col("lang") == F.col("_lang"), "left").withColumn("failed", failed)
    return joined.select("doc_id", "lang", *_COUNTS, "base_failed", "failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))
