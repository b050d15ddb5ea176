"""Statistics, distinct counts and samples that read or scan less, against those that read everything."""

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import distinct, statistics
from millrace.operators.ranking import rank_by_range
from millrace.operators.sampling import bucket_sample, table_bucket_sample
from millrace.session import bucketed_scans

from conftest import plan_of


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files_read(df) -> int:
    """The number of files the scan of a collected frame opened."""
    df.collect()
    found, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            found += metrics.apply("numFiles").value()
        left += [node.children().apply(i) for i in range(node.children().length())]
    return found


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE sampled LOCATION '{tmp_path_factory.mktemp('sampled')}'")
    rows = spark.range(0, 5_000, 1, 3).select(F.concat(F.lit("ip"), F.col("id") % 900).alias("ip"), "id", (F.col("id") % 3).cast("string").alias("dt"))
    rows.withColumn("ip", F.when(F.col("id") % 50 > 0, F.col("ip"))).write.partitionBy("dt").bucketBy(32, "ip").format("orc").saveAsTable("sampled.t")
    rows.write.saveAsTable("sampled.plain")
    yield "sampled.t"
    spark.sql("DROP DATABASE sampled CASCADE")


@pytest.mark.parametrize("of", [32, 8, 64, 3, 1])
def test_a_bucket_comes_from_its_files(spark, bucketed, of):
    table = spark.table(bucketed)
    every = files_read(table)
    for bucket in {1, of}:
        mine = table_bucket_sample(spark, bucketed, bucket, of)
        assert same_rows(mine, bucket_sample(table, "ip", bucket, of))
    few = files_read(table_bucket_sample(spark, bucketed, 1, of))
    assert few == every if of in (1, 3) else 0 < few <= every / 32 * max(1, 32 // of) * 2


def test_bucket_files_with_bucketed_scans_and_other_tables(spark, bucketed):
    with bucketed_scans(spark):
        assert same_rows(table_bucket_sample(spark, bucketed, 2, 32), bucket_sample(spark.table(bucketed), "ip", 2, 32))
    with pytest.raises(ValueError):
        table_bucket_sample(spark, "sampled.plain", 1, 32)


@pytest.fixture(scope="module")
def facts(spark):
    return spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 20 > 0, F.concat(F.lit("v"), (F.col("id") * 7919) % 4_000)).alias("who"), (F.col("id") % 5).cast("string").alias("dt"),
        (F.col("id") % 24).cast("int").alias("hour"), F.when(F.col("id") % 7 > 0, (F.col("id") * 31 % 1_001).cast("double")).alias("x"), "id")


def test_days_merge_to_the_whole(spark, facts, tmp_path):
    columns, path = ["who", "x", "hour", "id"], str(tmp_path / "s")
    daily = statistics.daily_statistics(facts, columns)
    assert daily.count() == 20
    merged = {r["column_name"]: r for r in statistics.merged_statistics(daily).collect()}
    for c in columns:
        exact = facts.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.min(c), F.max(c), F.countDistinct(c)).first()
        r = merged[c]
        kind = "text" if c == "who" else "number"
        assert (r["row_count"], r["null_count"], r[f"min_{kind}"], r[f"max_{kind}"]) == tuple(exact)[:4]
        assert abs(r["approx_distinct"] - exact[4]) <= max(1, exact[4] * statistics.SKETCH_ERROR)
    assert statistics.merged_statistics(daily.limit(0)).collect() == []
    facts.write.partitionBy("dt").orc(path)  # one day alone is the scan of that day
    one = {r["column_name"]: r["row_count"] for r in statistics.merged_statistics(daily.filter("dt = '3'")).collect()}
    assert one == dict.fromkeys(columns, spark.read.orc(path).filter("dt = '3'").count())


def test_refreshed_days_replace_their_rows(spark, small_tables, tmp_path):
    from millrace.sources import catalog, sinks

    catalog.create_database(spark, "kept", str(tmp_path / "t"), "test", {"layer": "test"})
    catalog.create_processed_table(spark, "sensor_readings", "kept", bucketed=False)
    sinks.overwrite_table(small_tables.sensor_readings, "sensor_readings", "kept")
    folder = str(tmp_path / "stats")
    statistics.refresh_statistics(spark, "sensor_readings", folder, database="kept")
    day = "2024-01-03"
    sinks.overwrite_table(small_tables.sensor_readings.filter(F.col("dt") == day).limit(1), "sensor_readings", "kept")
    statistics.refresh_statistics(spark, "sensor_readings", folder, [day], "kept")
    (r,) = statistics.stored_statistics(spark, "sensor_readings", folder).filter("column_name = 'device_id'").collect()
    assert r["row_count"] == spark.table("kept.sensor_readings").count()
    spark.sql("DROP DATABASE kept CASCADE")


def test_distinct_counts_on_every_grain(facts):
    by = ["dt", "hour"]
    bits = distinct.bitmaps(facts, "who", distinct.dictionary(facts, "who"), by)
    mine = distinct.distinct_by_grain(bits, by, [by, ["dt"], ["hour"], []], "n").drop("grain")
    plain = facts.groupingSets([by, ["dt"], ["hour"], []], *by).agg(F.countDistinct("who").alias("n"))
    assert same_rows(mine, plain)
    plan = plan_of(mine)
    assert "Expand" in plan and "who" not in plan.split("Expand")[0]  # facts are not repeated per grain


def test_bitmaps_of_nothing_and_of_nulls(facts):
    empty = facts.limit(0)
    assert distinct.bitmaps(empty, "who", distinct.dictionary(empty, "who"), ["dt"]).collect() == []
    nulls = facts.filter("who is null")
    bits = distinct.bitmaps(nulls, "who", distinct.dictionary(facts, "who"), ["dt"])
    assert {r["n"] for r in distinct.distinct_by_grain(bits, ["dt"], [["dt"], []], "n").collect()} == {0}


@pytest.mark.parametrize("measure", ["x", "id", "who"])
def test_ranks_of_any_measure_equal_window_functions(spark, facts, measure):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mine = rank_by_range(facts, measure, "r", "d", "p")
        w = Window.orderBy(F.desc_nulls_last(measure))
        plain = facts.select("*", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"), F.percent_rank().over(w).alias("p"))
        assert same_rows(mine.select(*plain.columns), plain)
        plan = plan_of(mine)
        # What is broadcast has one row per partition; values are joined by a shuffle.
        assert plan.count("BroadcastHashJoin (") <= 1 and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rank_by_range(facts.limit(0), measure, "r", "d", "p").collect() == []
    assert [r["p"] for r in rank_by_range(facts.limit(1), measure, "r", "d", "p").collect()] == [0.0]
