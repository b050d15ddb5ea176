"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written

MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node it reaches) for links (a, b).

    Alternates large-star and small-star steps until nothing changes, about
    log(n) rounds. Each round groups with partial aggregates and goes through
    files of the shared folder. Raises if it does not settle.
    """
    edges = written(links.filter("a <> b").select("a", "b"), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "large-star")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(joined.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
