"""The pipeline's stages, one by one, on what the stage before kept."""

from __future__ import annotations

import pandas as pd

import corpus_pipeline
from millrace.llm import decontamination
from millrace.llm.common import table
from tests.llm.test_basic_operators import norm
from tests.llm.test_decontamination import all_windows
from tests.llm.test_near_copies import brute as near_group_firsts
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs, kept = table(spark, SMALL, "documents"), {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        kept[name] = ({r["doc_id"]: r["text"] for r in before.collect()}, {r["doc_id"] for r in docs.collect()})
        if n < 4:
            assert docs.columns == before.columns
    labels = dict(pd.read_parquet(f"{SMALL}/labels.parquet")[["doc_id", "toxic"]].itertuples(index=False))
    texts, left = kept["toxicity"]
    clean = [i for i in texts if labels.get(i) == 0]
    assert sum(i in left for i in clean) >= 0.9 * len(clean)

    texts, left = kept["exact dedup"]
    firsts = {}
    for i in sorted(texts):
        firsts.setdefault(norm(texts[i]), i)
    assert left == set(firsts.values())

    texts, left = kept["SimHash near-dedup"]
    assert left == near_group_firsts(texts)

    texts, left = kept["benchmark decontamination"]
    items = list(pd.read_parquet(f"{SMALL}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False))
    assert left == set(texts) - {d for d, _ in all_windows(list(texts.items()), items, decontamination.SIMILAR)}

    assert kept["SentencePiece"][1] == set(kept["SentencePiece"][0])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()} == kept["SentencePiece"][1]


def test_odd_rows_go_through(rows_of, spark, tmp_path):
    docs = rows_of([(None, None, "x", None, 1), (1, "a b", None, "s", None), (1, "a b", None, "s", None), (2, "", "x", "y", 0), (3, "long text " * 30_000, "x", "y", 1)],
                   "doc_id long, text string, lang string, source string, n_chars long")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(1) == 1 and 3 in ids
