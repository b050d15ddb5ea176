"""From raw documents to token ids in five stages.

Each stage gets the Parquet files of the one before; all but the last return the
columns of ``documents``.

Near-duplicates: five-word shingles of a Jaccard similarity of 0.8 or more. SimHash
(``op6``) links fingerprints within three bits, an exact comparison follows, and
``near_copies`` finds the similar pairs whose fingerprints lie further apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, exact_dedup, near_copies, sentencepiece_codec, toxicity
from millrace.llm.common import scratch, table
from millrace.llm.queries import SENTENCEPIECE_MODEL
from millrace.session import shared_folder
from millrace.sources import files

#: No SQL expresses the nearest-neighbour votes of the first stage.
ORACLE_SQL = None


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.first_copies(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: by SimHash, then by what lies beyond its radius."""
    return near_copies.group_firsts(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontamination.without_matches(docs, table(spark, sf_dir, "benchmark"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids."""
    vocabulary = sentencepiece_codec.Vocabulary.load(SENTENCEPIECE_MODEL)
    return sentencepiece_codec.encoded(docs.select("doc_id", "text"), vocabulary).drop("text")


STAGES = [
    ("toxicity", keep_clean),
    ("exact dedup", keep_first_copies),
    ("SimHash near-dedup", keep_one_of_near),
    ("benchmark decontamination", keep_uncontaminated),
    ("SentencePiece", to_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, read from its files ``pipeline-*`` in the shared folder; all else that was written is gone."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            files.delete(spark, f"{folder}/{number - 1}")
    return docs
