"""The registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat, collocations, conversation_trie, decontamination, exact_dedup, html_extraction, phrase_dedup, quality_rules, sentencepiece_codec, sharding, simhash,
    suffix_dedup, toxicity,
)
from .common import table, text_or_empty

SHARDS = 40
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    awkward = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(awkward).alias("text"))
    made = chat.formatted(turns.unionByName(extra))
    read = made.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    digest = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffled(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    return placed.select(
        "doc_id", sharding.record_size().alias("size"), F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    result = toxicity.scored(docs, model)
    return result.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "evidence", "similarity")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = SENTENCEPIECE_MODEL) -> DataFrame:
    vocabulary = sentencepiece_codec.Vocabulary.load(model_path)
    coded = sentencepiece_codec.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    read = sentencepiece_codec.decoded(coded, vocabulary)
    return read.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (F.col("decoded") == text_or_empty()).alias("round_trip"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = conversation_trie.rebuilt(conversation_trie.placed(table(spark, sf_dir, "conversations")))
    return conversation_trie.trie(turns, members).drop("left_over")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_suffix_dedup, op3_chat_formatting, op4_sharding, op5_toxicity, op6_simhash_dedup, op7_decontamination, op8_phrase_dedup,
    op9_sentencepiece, op10_html_extraction, op11_conversation_trie, op12_quality_rules, op13_collocation_mining,
)}
