"""Table definitions, writes, maintenance and the whole load."""

import datetime as dt
import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import curate, daily_load, rollups, upkeep
from millrace.session import bucketed_scans, shared_folder
from millrace.sources import adapters, catalog, raw, sinks
from millrace.tables import catalog_tables

from conftest import SMALL, plan_of

_names = itertools.count()


@pytest.fixture
def database(spark, tmp_path):
    name = f"db{next(_names)}"
    catalog.create_database(spark, name, str(tmp_path / "processed"), "test", {"layer": "processed"})
    catalog.create_processed_tables(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """The raw sources as files, loaded from there into tables."""
    root = str(tmp_path_factory.mktemp("lake"))
    landing = f"{root}/raw"
    adapters.web_log_lines(spark, SMALL).write.text(f"{landing}/web_logs")
    csv = {"iot_sensors": adapters.raw_sensor_readings, "device_metadata": adapters.raw_device_metadata}
    for folder, make in csv.items():
        make(spark, SMALL).write.option("header", True).csv(f"{landing}/{folder}")
    adapters.raw_social_posts(spark, SMALL).write.option("header", True).option(
        "quoteAll", True).option("escape", '"').csv(f"{landing}/social_media")
    counts = daily_load.run(spark, root)
    yield root, counts
    spark.sql("DROP DATABASE processed_db CASCADE")
    spark.sql("DROP DATABASE raw_db CASCADE")


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_load_from_files_equals_derived_tables(spark, loaded, small_tables):
    stored = catalog_tables(spark)
    for name in ("web_traffic", "sensor_readings", "device_metadata", "sensor_daily_summary", "trending_hashtags_daily"):
        assert same_rows(getattr(stored, name), getattr(small_tables, name).select(*getattr(stored, name).columns)), name
    assert same_rows(stored.social_posts, small_tables.social_posts.select(*stored.social_posts.columns))


def test_reports_are_written_with_headers(spark, loaded):
    root, counts = loaded
    assert set(counts) == set(daily_load.REPORTS)
    for name, n in counts.items():
        back = spark.read.option("header", True).csv(f"{root}/output/{name}")
        assert back.count() == n > 0
    assert counts["trending_hashtags"] == 20


def test_layouts(spark, loaded):
    described = {r.col_name: r.data_type for r in catalog.describe_table(spark, "processed_db.web_traffic").collect()}
    assert described["Num Buckets"] == "32" and described["Bucket Columns"] == "[`client_ip`]"
    assert described["Statistics"].endswith("rows")
    assert {r.tableName for r in catalog.list_tables(spark, "processed_db").collect()} == set(catalog.LAYOUTS)
    assert {r.tableName for r in catalog.list_tables(spark, "raw_db").collect()} == set(catalog.RAW_FOLDERS)
    assert {"processed_db", "raw_db"} <= {r[0] for r in catalog.list_databases(spark).collect()}
    info = {r.info_name: r.info_value for r in catalog.describe_database(spark, "processed_db").collect()}
    assert "90_days" in info["Properties"]


def test_orc_settings_reach_the_files(loaded):
    from pyarrow import orc

    root, _ = loaded
    for name, layout in catalog.LAYOUTS.items():
        file = orc.ORCFile(next(Path(f"{root}/processed/{name}").glob("**/*.orc")))
        assert file.compression == layout.compress
        assert file.row_index_stride == 10000


def test_dropping_a_raw_table_keeps_its_files(spark, loaded):
    root, _ = loaded
    spark.sql("DROP TABLE raw_db.raw_sensor_readings")
    assert raw.scan_sensor_csv(spark, f"{root}/raw/iot_sensors").count() > 0
    catalog.create_raw_tables(spark, root)
    assert spark.table("raw_db.raw_sensor_readings").count() == adapters.raw_sensor_readings(spark, SMALL).count()
    assert raw.parse_log_lines(spark.table("raw_db.raw_web_logs")).count() > 0


def test_pruning_and_pushdown(spark, loaded):
    from millrace.plans import sensors, web

    stored = catalog_tables(spark)
    plan = plan_of(web.day_top_urls(stored))
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(http_status,200)" in plan
    assert "Batched: true" in plan and "TakeOrderedAndProject" in plan
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert read == ["ReadSchema: struct<url_path:string,http_status:int,response_bytes:bigint>"]
    plan = plan_of(sensors.zone_day_temps(stored))
    assert "zone" in plan.split("PartitionFilters:")[1].split("\n")[0] and "IsNotNull(temperature)" in plan
    plan = plan_of(sensors.threshold_alerts(stored))
    assert "2024-01-15" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert "BroadcastHashJoin" in plan


def test_statistics_reach_the_optimizer(spark, loaded):
    found = spark.sql("DESCRIBE EXTENDED processed_db.sensor_readings device_id").collect()
    stats = {r.info_name: r.info_value for r in found}
    assert int(stats["distinct_count"]) > 0 and stats["num_nulls"] == "0"


def test_sampled_buckets_are_the_bucket_files(spark, loaded):
    """Each row lies in the file of the bucket that the sample puts it in."""
    web = spark.table("processed_db.web_traffic")
    file_bucket = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c\d+", 1).try_cast("int")
    placed = web.select(file_bucket.alias("in_file"), F.pmod(F.hash("client_ip"), F.lit(32)).alias("sampled"))
    assert placed.filter("in_file is null or in_file <> sampled").isEmpty()
    assert placed.select("in_file").distinct().count() > 1


def test_bucketed_join_needs_no_shuffle(spark, tmp_path):
    name = f"db{next(_names)}"
    catalog.create_database(spark, name, str(tmp_path / "b"), "test", {"layer": "test"})
    for t, make in (("facts", adapters.raw_sensor_readings), ("dims", adapters.raw_device_metadata)):
        make(spark, SMALL).write.bucketBy(8, "device_id").sortBy("device_id").saveAsTable(f"{name}.{t}")
    with bucketed_scans(spark):
        joined = spark.table(f"{name}.facts").join(spark.table(f"{name}.dims").hint("merge"), "device_id")
        plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_shuffle_join_is_a_merge_join(small_tables):
    from millrace.plans import relational

    assert "SortMergeJoin" in plan_of(relational.join_shuffle(small_tables))


def test_overwrite_keeps_other_days_and_repeats(spark, database, small_tables):
    web = small_tables.web_traffic
    sinks.overwrite_table(web, "web_traffic", database)
    before = spark.table(f"{database}.web_traffic").count()
    one_day = web.filter("dt = '2024-01-03'").limit(1)
    lost = web.filter("dt = '2024-01-03'").count() - 1
    for _ in range(2):
        sinks.overwrite_table(one_day, "web_traffic", database)
        assert spark.table(f"{database}.web_traffic").count() == before - lost


def test_overwrite_is_dynamic_whatever_the_session_says(spark, database, small_tables):
    summary = small_tables.sensor_daily_summary
    sinks.overwrite_table(summary, "sensor_daily_summary", database)
    total = spark.table(f"{database}.sensor_daily_summary").count()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        sinks.overwrite_table(summary.filter("dt = '2024-01-03'"), "sensor_daily_summary", database)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert spark.table(f"{database}.sensor_daily_summary").count() == total


def test_dimension_is_replaced(spark, database, small_tables):
    devices = small_tables.device_metadata
    sinks.overwrite_table(devices, "device_metadata", database)
    sinks.overwrite_table(devices.limit(3), "device_metadata", database)
    assert spark.table(f"{database}.device_metadata").count() == 3


def test_scans_do_not_follow_the_bucket_count(spark, loaded):
    plan = plan_of(spark.table("processed_db.sensor_readings").groupBy("device_id").count())
    assert "Bucketed: false" in plan and "Exchange" in plan


def test_unbucketed_tables_hold_the_same_rows(spark, tmp_path, small_tables):
    name = f"db{next(_names)}"
    catalog.create_database(spark, name, str(tmp_path / "u"), "test", {"layer": "test"})
    catalog.create_processed_table(spark, "web_traffic", name, bucketed=False)
    sinks.overwrite_table(small_tables.web_traffic, "web_traffic", name)
    assert same_rows(spark.table(f"{name}.web_traffic"), small_tables.web_traffic)
    assert len(list((tmp_path / "u").glob("**/*.orc"))) == small_tables.web_traffic.select("dt").distinct().count()
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_partition_guard(database, small_tables):
    with pytest.raises(ValueError):
        sinks.overwrite_table(small_tables.web_traffic, "web_traffic", database, max_partitions=2)


def test_path_overwrite(spark, tmp_path, small_tables):
    path = str(tmp_path / "orc")
    sinks.overwrite_path(small_tables.sensor_daily_summary, path, ["dt"])
    sinks.overwrite_path(small_tables.sensor_daily_summary.filter("dt = '2024-01-03'"), path, ["dt"])
    back = spark.read.orc(path)
    assert back.count() == small_tables.sensor_daily_summary.count()
    assert dict(back.dtypes)["dt"] == "string"


def test_multi_insert(spark, database, small_tables):
    sinks.multi_insert(
        small_tables.sensor_readings,
        [(curate.sensor_daily_summary, "sensor_daily_summary"), (lambda df: df, "sensor_readings")], database,
    )
    assert spark.table(f"{database}.sensor_readings").count() == small_tables.sensor_readings.count()
    assert same_rows(spark.table(f"{database}.sensor_daily_summary"), small_tables.sensor_daily_summary)
    assert list(Path(shared_folder(spark)).glob("staged-*")) == []


def test_compaction_keeps_the_rows(spark, database, small_tables):
    readings = small_tables.sensor_readings
    spec = {"dt": "2024-01-03", "zone": "zone-5"}
    sinks.overwrite_table(readings, "sensor_readings", database)
    table = f"{database}.sensor_readings"
    day = readings.filter("dt = '2024-01-03' and zone = 'zone-5'").select(*schemas.PROCESSED["sensor_readings"].names)
    day.repartition(4).write.insertInto(table)  # small files beside those there
    files, _ = upkeep.partition_files(spark, table, spec)
    assert upkeep.compact_partition(spark, "sensor_readings", spec, database)
    assert upkeep.partition_files(spark, table, spec)[0] < files
    assert spark.table(table).count() == readings.count() + day.count()
    assert not upkeep.compact_partition(spark, "sensor_readings", spec, database, small_bytes=1)


def test_retention(spark, database, small_tables):
    sinks.overwrite_table(small_tables.web_traffic, "web_traffic", database)
    sinks.overwrite_table(small_tables.sensor_readings, "sensor_readings", database)
    last_kept = dt.date(2024, 1, 10)
    as_of = str(last_kept + dt.timedelta(days=90))
    for name in ("web_traffic", "sensor_readings"):
        gone = upkeep.prune_partitions(spark, name, as_of, database)
        assert gone and max(gone) == "2024-01-09"
        assert spark.table(f"{database}.{name}").agg(F.min("dt")).first()[0] == "2024-01-10"
        assert upkeep.prune_partitions(spark, name, as_of, database) == []


def test_csv_forms(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), ("c", 2)], "x string, n int").orderBy("n")
    assert sinks.csv_export(df, str(tmp_path / "c"), single_file=True) == 2
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_text() == 'x,n\n"a,b",1\nc,2\n'
    odd = spark.createDataFrame([(' say "hi" ', 1), ("", 2), (None, 3)], "x string, n int").orderBy("n")
    sinks.csv_export(odd, str(tmp_path / "o"), single_file=True)
    (part,) = (tmp_path / "o").glob("part-*")
    assert part.read_text() == 'x,n\n" say ""hi"" ",1\n"",2\n,3\n'
    sinks.csv_export(df, str(tmp_path / "t"), sep="\t", single_file=True)
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_text() == "x\tn\na,b\t1\nc\t2\n"
    sinks.csv_export(df, str(tmp_path / "q"), quote_all=True, single_file=True)
    (part,) = (tmp_path / "q").glob("part-*")
    assert part.read_text().splitlines()[1] == '"a,b","1"'
    sinks.delimited_folder(df, str(tmp_path / "d"))
    assert "x" not in "".join(p.read_text() for p in (tmp_path / "d").glob("part-*"))


def test_archive(spark, tmp_path):
    (tmp_path / "web").mkdir()
    (tmp_path / "web" / "a.log").write_text("one\ntwo\n")
    target = sinks.archive_snapshot(spark, str(tmp_path / "web"), str(tmp_path / "archive"), "2024-01-31", "web_logs")
    assert target.endswith("archive/2024-01-31/web_logs")
    assert sorted(r.value for r in spark.read.text(target).collect()) == ["one", "two"]


def test_rollup_equals_its_grouping_sets(small_tables):
    figures = [F.sum("total_readings").alias("n")]
    daily = small_tables.sensor_daily_summary
    rolled = daily.rollup("dt", "zone", "device_id").agg(*figures)
    sets = daily.groupingSets([["dt", "zone", "device_id"], ["dt", "zone"], ["dt"], []], "dt", "zone", "device_id").agg(*figures)
    assert same_rows(rolled, sets)


def test_finest_grain_adds_up_to_the_total(small_tables):
    rows = rollups.grouping_sets(small_tables).collect()
    fine = [r for r in rows if "ALL" not in r.device_key and "ALL" not in r.date_key]
    (total,) = [r for r in rows if r.date_key == "ALL_DATES"]
    assert sum(r.total_readings for r in fine) == total.total_readings
    assert sum(r.total_anomalies for r in fine) == total.total_anomalies


def test_loading_one_day_leaves_the_others(spark, loaded):
    root, _ = loaded
    table = "processed_db.web_traffic"
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dt = '2024-01-03')")
    before = spark.table(table).filter("dt <> '2024-01-05'").groupBy("dt").count().collect()
    one_day = spark.table(table).filter("dt = '2024-01-05'").count()
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dt = '2024-01-05')")
    daily_load.load(spark, {"web_traffic": daily_load.landing_zone(spark, root)["web_traffic"]}, days=("2024-01-05", "2024-01-05"))
    after = spark.table(table).groupBy("dt").count()
    assert sorted(after.filter("dt <> '2024-01-05'").collect()) == sorted(before)
    assert after.filter("dt = '2024-01-05'").first()["count"] == one_day
    assert after.filter("dt = '2024-01-03'").isEmpty()
    daily_load.load(spark, {"web_traffic": daily_load.landing_zone(spark, root)["web_traffic"]}, days=("2024-01-03", "2024-01-03"))
