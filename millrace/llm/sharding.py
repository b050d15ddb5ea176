"""Two-pass external shuffle into shards, in DataFrame functions only.

Pass one scatters the records by a seeded hash into buckets that fit into
memory. Pass two draws a Fisher-Yates permutation of each bucket (Spark's
``shuffle`` is one) and deals the permuted records out. The buckets follow one
another, so record ``g`` of the whole order goes to place ``g div shards`` of
shard ``g mod shards``: row counts differ by one at most, places have no gap.

Cases: null texts count as empty, null ids are ordinary values; repeated rows
each get a place; an empty table gives an empty result. Extra columns pass
through, but ``shard`` and ``slot`` of the input are replaced. Rows equal in all
key columns share a bucket; its sort spills, so such a bucket may outgrow memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import partitions_for, text_or_empty

BUCKET_BYTES = 32 * 1024 * 1024
BUCKET_ROWS = 1_000_000
ROW_OVERHEAD = 16


def record_size():
    """Bytes of the text in UTF-8 plus 16."""
    return (F.octet_length(text_or_empty()) + F.lit(ROW_OVERHEAD)).cast("long")


def shuffled(docs: DataFrame, shards: int, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) plus ``shard`` and ``slot``."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    records = docs.select(*[F.col(f"`{c}`") for c in kept])
    total = records.agg(F.coalesce(F.sum(record_size()), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(partitions_for(total["bytes"], bucket_bytes), partitions_for(total["rows"], BUCKET_ROWS))

    place = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    scattered = records.withColumn("__place", place).withColumn("__bucket", F.pmod("__place", F.lit(buckets)).cast("int"))
    ranks = Window.partitionBy("__bucket").orderBy("__place", "doc_id")
    numbered = scattered.withColumn("__rank", F.row_number().over(ranks))

    # One narrow row per bucket: where it starts in the whole order, and its size. Each bucket's permutation is drawn beside
    # that bucket only: the rows are dealt by bucket, permutations included, so none of them travels to all tasks.
    sizes = scattered.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("__bucket").alias("__of"), "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    drawn = starts.repartition("__of").select(
        "__of", "__start", F.shuffle(F.sequence(F.lit(0), (F.col("__n") - 1).cast("int")), seed).alias("__order")).hint("merge")
    order = F.col("__start") + F.element_at("__order", F.col("__rank"))
    dealt = numbered.join(drawn, F.col("__bucket") == F.col("__of")).select(*[F.col(f"`{c}`") for c in kept], order.alias("__at"))
    return dealt.select(
        *[F.col(f"`{c}`") for c in kept],
        (F.col("__at") % shards).cast("int").alias("shard"), F.floor(F.col("__at") / shards).cast("long").alias("slot"),
    )


def write_shards(placed: DataFrame, path: str, records_per_file: int = 1_000_000) -> None:
    """One folder per shard; files hold runs of the shard's order, in order."""
    pieces = placed.withColumn("__piece", F.floor(F.col("slot") / records_per_file))
    (
        pieces.repartition("shard", "__piece").sortWithinPartitions("shard", "slot").drop("__piece")
        .write.partitionBy("shard").parquet(path)
    )
