"""Compaction of whole tables, snapshots of what is new, several tables from one pass."""

import itertools
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import compaction
from millrace.sources import archive, catalog, files, sinks
from millrace.sources.split_insert import Branch, split_insert, tagged

from conftest import plan_of

_names = itertools.count()


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def database(spark, tmp_path):
    name = f"upkeep{next(_names)}"
    catalog.create_database(spark, name, str(tmp_path / "tables"), "test", {"layer": "processed"})
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def listing(spark, table):
    return {r["path"]: (r["bytes"], r["modified"]) for r in files.listed(spark, files.table_folder(spark, table)).collect()}


def in_pieces(spark, database, df, name, bucketed, pieces=3):
    catalog.create_processed_table(spark, name, database, bucketed)
    for _ in range(pieces):
        df.write.insertInto(f"{database}.{name}")


# -- compaction --------------------------------------------------------


@pytest.mark.parametrize("bucketed", [False, True])
def test_compaction_of_a_table(spark, database, small_tables, bucketed):
    readings = small_tables.sensor_readings.filter("dt <= '2024-01-04'").select(*schemas.PROCESSED["sensor_readings"].names)
    table = f"{database}.sensor_readings"
    in_pieces(spark, database, readings, "sensor_readings", bucketed)
    before, rows = listing(spark, table), spark.table(table).collect()
    limit = sorted(b for b, _ in before.values())[len(before) // 2]
    plan = compaction.plan_compaction(spark, table, small_bytes=limit).collect()
    groups = {(r["folder"], r["bucket"], r["bin"]) for r in plan}
    assert groups and all((r["bucket"] != "") == bucketed and r["bytes"] < limit for r in plan)
    done = compaction.compact_table(spark, "sensor_readings", database, small_bytes=limit, files_at_once=50)
    after = listing(spark, table)
    assert (done.groups, done.files_before, done.files_after) == (len(groups), len(plan), len(groups))
    assert len(after) == len(before) - len(plan) + len(groups)
    assert {p: v for p, v in before.items() if p not in {r["path"] for r in plan}}.items() <= after.items()
    assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, rows))
    if bucketed:  # the names still tell the bucket
        found = spark.table(table).select(F.regexp_extract("_metadata.file_name", r"_(\d+)\.", 1).cast("int").alias("named"),
                                          F.pmod(F.hash("device_id"), F.lit(16)).alias("bucket"))
        assert found.filter("named <> bucket").isEmpty()
    assert not files.exists(spark, f"{files.table_folder(spark, table)}/_compaction")


def test_bins_hold_the_target_size(spark, database, small_tables):
    in_pieces(spark, database, small_tables.sensor_daily_summary.repartition(6), "sensor_daily_summary", False)
    table = f"{database}.sensor_daily_summary"
    largest = max(b for b, _ in listing(spark, table).values())
    target = 4 * largest
    bins = {}
    for r in compaction.plan_compaction(spark, table, target, largest + 1).collect():
        bins.setdefault(r["folder"], {}).setdefault(r["bin"], []).append(r["bytes"])
    assert max(map(len, bins.values())) > 1
    for own in bins.values():
        assert all(target - largest <= sum(own[b]) < target + largest for b in own if b < max(own))
    rows = spark.table(table).collect()
    compaction.compact_table(spark, "sensor_daily_summary", database, target, largest + 1)
    assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, rows))
    assert compaction.compact_table(spark, "sensor_daily_summary", database).files_after <= len(bins)
    assert compaction.compact_table(spark, "sensor_daily_summary", database) == compaction.Compacted(0, 0, 0)


def test_compaction_that_breaks_off(spark, database, small_tables, monkeypatch):
    df = small_tables.sensor_daily_summary
    in_pieces(spark, database, df, "sensor_daily_summary", False)
    table, whole = f"{database}.sensor_daily_summary", df.union(df).union(df)
    finish, move = compaction.finish_exchanges, files.move

    def fail(*_):
        raise OSError("broken off")

    # Before the journal is complete: the table is as it was, what was written goes.
    monkeypatch.setattr(compaction, "finish_exchanges", lambda s, t: finish(s, t) if not files.children(s, f"{files.table_folder(s, t)}/_compaction") else fail())
    with pytest.raises(OSError):
        compaction.compact_table(spark, "sensor_daily_summary", database)
    monkeypatch.setattr(compaction, "finish_exchanges", finish)
    assert same_rows(spark.table(table), whole)
    (work,) = files.children(spark, f"{files.table_folder(spark, table)}/_compaction")
    # After some of the exchange: the next run carries on from the journal.
    moves = itertools.count()
    monkeypatch.setattr(files, "move", lambda *a: move(*a) if next(moves) % 2 else fail())
    with pytest.raises(OSError):
        finish(spark, table)
    monkeypatch.setattr(files, "move", move)
    compaction.compact_table(spark, "sensor_daily_summary", database)
    assert same_rows(spark.table(table), whole)
    # Without a journal the work is dropped.
    stray = f"{files.table_folder(spark, table)}/_compaction/x/files"
    df.write.orc(stray)
    compaction.finish_exchanges(spark, table)
    assert not files.exists(spark, stray) and same_rows(spark.table(table), whole)


def test_bloom_filters_and_stripes_are_in_the_files(spark, database, small_tables):
    in_pieces(spark, database, small_tables.web_traffic.select(*schemas.PROCESSED["web_traffic"].names), "web_traffic", False, 1)
    path = next(iter(listing(spark, f"{database}.web_traffic")))
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == 10_000 and reader.getCompressionKind().toString() == "ZLIB"
    # Only files with a filter are searched for more than their extremes.
    include = spark.sparkContext._gateway.new_array(jvm.boolean, reader.getSchema().getMaximumId() + 1)
    for i in range(len(include)):
        include[i] = True
    indexes = reader.rows().readRowIndex(0, include, include)
    filters = indexes.getBloomFilterIndex()
    names = reader.getSchema().getFieldNames()
    with_filter = {names[i] for i in range(names.size()) if filters[i + 1] is not None}
    assert with_filter == set(catalog.LAYOUTS["web_traffic"].bloom)


# -- snapshots ---------------------------------------------------------


def tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in Path(root).rglob("*") if p.is_file() and not p.name.startswith((".", "_"))}


def test_a_snapshot_copies_additions_only(spark, tmp_path):
    source, root = tmp_path / "web", str(tmp_path / "archive")
    (source / "dt=1 a").mkdir(parents=True)
    contents = {"a.log": b"one\r\ntwo", "dt=1 a/b%20c.bin": bytes(range(256)) * 40, "last.log": b"x"}
    for name, data in contents.items():
        (source / name).write_bytes(data)
    first = archive.snapshot(spark, str(source), root, "web_logs", "2024-01-01", piece_bytes=1000)
    assert {r["name"] for r in first.collect()} == set(contents) and first.filter("name like '%bin'").count() == 11
    assert archive.snapshot(spark, str(source), root, "web_logs", "2024-01-02", piece_bytes=1000).isEmpty()

    (source / "a.log").write_bytes(b"changed")
    os.utime(source / "a.log", (10**9, 10**9))
    (source / "new.log").write_bytes(b"more\n")
    (source / "last.log").unlink()
    (source / "empty").write_bytes(b"")  # has no bytes to keep
    third = archive.snapshot(spark, str(source), root, "web_logs", "2024-01-03", piece_bytes=1000)
    assert sorted(r["name"] for r in third.collect()) == ["a.log", "new.log"]
    assert archive.snapshots(spark, root, "web_logs") == ["2024-01-01", "2024-01-02", "2024-01-03"]

    for day, want in (("2024-01-01", contents), ("2024-01-02", contents), ("2024-01-03", {"a.log": b"changed", "dt=1 a/b%20c.bin": contents["dt=1 a/b%20c.bin"], "new.log": b"more\n"})):
        assert archive.restore(spark, root, "web_logs", day, str(tmp_path / day)) == len(want)
        assert tree(tmp_path / day) == want
    # Taking a day again leaves the others right.
    archive.snapshot(spark, str(source), root, "web_logs", "2024-01-03")
    archive.restore(spark, root, "web_logs", "2024-01-03", str(tmp_path / "again"))
    assert tree(tmp_path / "again") == tree(tmp_path / "2024-01-03")


def test_damage_is_found_and_half_copies_have_no_name(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "archive"
    source.mkdir()
    (source / "x").write_bytes(b"abc" * 100)
    archive.snapshot(spark, str(source), str(root), "s", "1")
    (stored,) = [p for p in (root / "objects").rglob("*-0") if p.is_file()]
    stored.write_bytes(b"abd" * 100)
    with pytest.raises(Exception, match="damaged"):
        archive.restore(spark, str(root), "s", "1", str(tmp_path / "out"))
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == []


def test_snapshot_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert archive.snapshot(spark, str(tmp_path / "in"), str(tmp_path / "a"), "s", "1").isEmpty()
    assert archive.restore(spark, str(tmp_path / "a"), "s", "1", str(tmp_path / "out")) == 0


# -- several tables from one pass --------------------------------------


def test_split_insert(spark, database):
    for name, more in (("every", ""), ("high", ", label STRING")):
        spark.sql(f"CREATE TABLE {database}.{name} (id BIGINT, x DOUBLE{more}, dt STRING, zone STRING) USING orc PARTITIONED BY (dt, zone)")
    source = spark.range(200).selectExpr("id", "double(id) / 2 AS x", "string(id % 3) AS dt", "if(id % 5 = 0, null, concat('z/= ', id % 5)) AS zone")
    branches = [Branch(f"{database}.every"), Branch(f"{database}.high", F.col("x") > 80, {"label": F.concat(F.lit("n"), F.col("id"))})]
    plan = plan_of(tagged(source, branches))
    assert plan.count("Range (") <= 2 and "Join" not in plan
    split_insert(source, branches)
    split_insert(source, branches)
    assert same_rows(spark.table(f"{database}.every"), source)
    high = source.filter("x > 80").selectExpr("id", "x", "concat('n', id) AS label", "dt", "zone")
    assert same_rows(spark.table(f"{database}.high"), high)
    # Partitions without rows in the source stay, the others are replaced.
    day = source.filter("dt = '1'").withColumn("x", F.lit(100.0))
    split_insert(day, branches)
    assert same_rows(spark.table(f"{database}.every"), source.filter("dt <> '1'").unionByName(day))
    assert spark.table(f"{database}.high").filter("dt = '1'").count() == day.count()
    home = Path(files.table_folder(spark, f"{database}.every").removeprefix("file:"))
    assert not [p for p in home.iterdir() if p.name.startswith("_")]


def test_split_insert_refuses_what_it_cannot_do(spark, database):
    catalog.create_processed_tables(spark, database)
    source = spark.table(f"{database}.web_traffic")
    for names in (["web_traffic"], ["device_metadata"], ["social_posts", "sensor_daily_summary"], ["social_posts"] * 2):
        with pytest.raises(ValueError):
            split_insert(source, [Branch(f"{database}.{n}") for n in names])
