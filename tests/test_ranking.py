"""Ranking and skew helpers against brute force."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from millrace.operators.profiling import column_cardinality, column_profile
from millrace.operators.ranking import number_rows, rank_by_measure
from millrace.operators.sampling import bucket_sample
from millrace.operators.skew import skew_join, two_pass_groupby
from millrace.operators.toplists import keep_top_keys, top_wide

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(1, 4)), min_size=1, max_size=25))
def test_ranks_equal_window_functions(spark, rows):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v bigint")
    mine = rank_by_measure(df, "v", within=["g"], rank="r", dense_rank="d", percent_rank="p")
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    plain = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.percent_rank().over(w).alias("p"))
    assert sorted(mine.collect(), key=str) == sorted(plain.collect(), key=str)


@few
@given(st.lists(st.integers(1, 3), min_size=1, max_size=20))
def test_row_numbers_follow_the_order(spark, values):
    df = spark.createDataFrame([(f"#k{i:03}", v) for i, v in enumerate(values)], "k string, v bigint")
    out = number_rows(df, [-F.col("v"), F.col("k")], "n").collect()
    want = sorted(((f"#k{i:03}", v) for i, v in enumerate(values)), key=lambda kv: (-kv[1], kv[0]))
    assert [(r.k, r.v, r.n) for r in sorted(out, key=lambda r: r.n)] == [(k, v, i + 1) for i, (k, v) in enumerate(want)]


def test_row_numbers_over_many_stretches(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("v"))
    out = number_rows(df, [F.col("v")], "n")
    plain = df.select("v", F.row_number().over(Window.orderBy("v")).cast("bigint").alias("n"))
    assert out.exceptAll(plain).isEmpty() and out.count() == 5000


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most of the rows."""
    rows = [("hot", i, float(i)) for i in range(400)] + [(f"k{i % 7}", 1000 + i, 1.0) for i in range(70)] + [(None, 5000, 1.0)]
    return spark.createDataFrame(rows, "k string, id bigint, v double")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, skewed, how):
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, d int")
    mine = skew_join(skewed, dim, "k", ["id"], how=how)
    plain = skewed.join(dim, "k", how)
    assert sorted(map(str, mine.select("id", "k", "v", "d").collect())) == sorted(map(str, plain.select("id", "k", "v", "d").collect()))


def test_hot_key_is_split_and_missing_keys_are_spread(spark, tmp_path):
    """With broadcasts off and small parts, the run splits the hot key; facts without a key take many keys."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, None).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v"),
    ).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dim = spark.range(97).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("d")).union(spark.sql("SELECT 'hot', -1L"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skew_join(fact, dim, "k", ["id"])
        assert len(joined.collect()) == 54_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        left = skew_join(fact, dim, "k", ["id"], how="left")
        assert left.count() == 60_000 and left.filter("d is null").count() == 6_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_skew_join_rejects_other_kinds(spark, skewed):
    with pytest.raises(ValueError):
        skew_join(skewed, skewed, "k", ["id"], how="outer")


def test_two_pass_grouping_counts_distinct_exactly(skewed):
    mine = two_pass_groupby(
        skewed, ["k"], [F.countDistinct("v").alias("d"), F.count("*").alias("n")],
        [F.sum("d").alias("d"), F.sum("n").alias("n")], spread=["v"], salts=7,
    )
    plain = skewed.groupBy("k").agg(F.countDistinct("v").alias("d"), F.count("*").alias("n"))
    assert sorted(map(str, mine.collect())) == sorted(map(str, plain.collect()))


def test_top_keys_with_equal_sums_go_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 5), ("a", 0)], "k string, n bigint")
    assert {r.k for r in keep_top_keys(df, "k", "n", 2).collect()} == {"a", "c"}


@pytest.mark.parametrize("k", [1, 150, 900, 5000])
def test_long_top_lists_are_exact(spark, k):
    df = spark.range(0, 3000, 1, 11).select((F.col("id") * 7919 % 3001).alias("v"), (F.col("id") % 3).alias("g"))
    assert top_wide(df, k, "v", "g", F.desc("v")).collect() == df.orderBy("g", F.desc("v")).limit(k).collect()


def test_buckets_part_the_table(skewed):
    parts = [bucket_sample(skewed, "k", b, 4) for b in range(1, 5)]
    assert sum(p.count() for p in parts) == skewed.count()
    owners = defaultdict(set)
    for i, p in enumerate(parts):
        for r in p.select("k").distinct().collect():
            owners[r.k].add(i)
    assert all(len(v) == 1 for v in owners.values())
    with pytest.raises(ValueError):
        bucket_sample(skewed, "k", 0, 4)


def test_profiles(skewed):
    rows = {r.column_name: r for r in column_profile(skewed, ["k", "id"]).collect()}
    assert (rows["k"].min_value, rows["k"].max_value, rows["k"].null_count) == ("hot", "k6", 1)
    assert (rows["id"].min_value, rows["id"].max_value, rows["id"].null_count) == ("0", "5000", 0)
    assert {r.column_name: r.approx_distinct for r in column_cardinality(skewed, ["k"]).collect()} == {"k": 8}
