"""Loads of new files against one load of everything."""

import itertools
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import incremental
from millrace.sources import adapters, catalog, sinks
from millrace.streaming import ingest

from conftest import SMALL

_names = itertools.count()
READINGS = ["1,D1,site,z,2024-01-01 10:00:00,20.5,40.0,OK,False", "2,D1,site,z,2024-01-02 10:00:00,21.5,40.0,OK,False"]


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def lake(spark, tmp_path):
    """A root folder and a database with empty tables, and the paths that loads scan."""
    name = f"lake{next(_names)}"
    catalog.create_database(spark, name, str(tmp_path / "tables"), "test", {"layer": "processed"})
    catalog.create_processed_tables(spark, name, bucketed=False)
    yield str(tmp_path), name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def scans(monkeypatch):
    """The files each load asks for."""
    seen = []
    for name, source in incremental.SOURCES.items():
        def read(spark, paths, source=source):
            df = source.read(spark, paths)
            seen.append({p.rsplit("/", 1)[1] for p in df.inputFiles()})
            return df

        monkeypatch.setitem(incremental.SOURCES, name, replace(source, read=read))
    return seen


def land(root, name, lines, folder="iot_sensors"):
    at = os.path.join(root, "raw", folder)
    os.makedirs(at, exist_ok=True)
    with open(os.path.join(at, name), "w") as f:
        f.write("\n".join([",".join(schemas.RAW_SENSOR.names), *lines]) + "\n")


def ids(spark, database):
    return sorted((r.reading_id, r.dt) for r in spark.table(f"{database}.sensor_readings").collect())


def load(spark, lake, *names):
    return incremental.load_new_files(spark, *lake, names or ("sensor_readings",))


def test_second_load_scans_the_new_file_only(spark, lake, scans):
    root, database = lake
    land(root, "a.csv", READINGS)
    assert load(spark, lake)["sensor_readings"].days == ["2024-01-01", "2024-01-02"]
    land(root, "b 1.csv", ["3,D1,site,z,2024-01-03 10:00:00,22.5,40.0,OK,False"])
    scans.clear()
    done = load(spark, lake)["sensor_readings"]
    assert [p.rsplit("/", 1)[1] for p in done.new] == ["b 1.csv"] and done.again == [] and done.days == ["2024-01-03"]
    assert [{f.replace("%20", " ") for f in s} for s in scans] == [{"b 1.csv"}]
    assert ids(spark, database) == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")]
    assert spark.table(f"{database}.sensor_daily_summary").count() == 3
    scans.clear()
    assert load(spark, lake)["sensor_readings"] == incremental.Loaded() and scans == []


def test_late_rows_bring_back_the_files_of_their_day(spark, lake):
    root, database = lake
    land(root, "a.csv", READINGS[:1])
    land(root, "b.csv", READINGS[1:])
    load(spark, lake)
    # A reading of the first day sent again under a lower id, and a new one of that day.
    land(root, "c.csv", ["0,D1,site,z,2024-01-01 10:00:00,9.5,40.0,OK,False", "4,D2,site,z,2024-01-01 11:00:00,9.5,40.0,OK,False"])
    done = load(spark, lake)["sensor_readings"]
    assert [p.rsplit("/", 1)[1] for p in done.again] == ["a.csv"] and done.days == ["2024-01-01"]
    assert ids(spark, database) == [(0, "2024-01-01"), (2, "2024-01-02"), (4, "2024-01-01")]


def test_a_replaced_file_takes_its_old_days_back(spark, lake):
    root, database = lake
    land(root, "a.csv", READINGS)
    land(root, "b.csv", ["5,D9,site,y,2024-01-02 10:00:00,21.5,40.0,OK,False"])
    load(spark, lake)
    land(root, "a.csv", ["1,D1,site,z,2024-01-04 10:00:00,20.5,40.0,OK,False"])
    done = load(spark, lake)["sensor_readings"]
    assert done.days == ["2024-01-01", "2024-01-02", "2024-01-04"] and len(done.again) == 1
    assert ids(spark, database) == [(1, "2024-01-04"), (5, "2024-01-02")]
    assert sorted(r.dt for r in spark.table(f"{database}.sensor_daily_summary").collect()) == ["2024-01-02", "2024-01-04"]


def test_a_load_that_failed_is_repeated(spark, lake, monkeypatch):
    root, database = lake
    land(root, "a.csv", READINGS)
    with monkeypatch.context() as m:
        m.setattr(incremental, "_record", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(spark, lake)
    before = ids(spark, database)
    assert load(spark, lake)["sensor_readings"].new and ids(spark, database) == before == [(1, "2024-01-01"), (2, "2024-01-02")]


def test_times_that_cannot_be_read_and_empty_files(spark, lake):
    root, database = lake
    land(root, "a.csv", ["1,D1,site,z,never,20.5,40.0,OK,False"])
    land(root, "empty.csv", [])
    assert load(spark, lake)["sensor_readings"].days == [incremental.NO_DAY]
    land(root, "b.csv", ["2,D2,site,z,never,20.5,40.0,OK,False"])
    assert len(load(spark, lake)["sensor_readings"].again) == 1
    assert ids(spark, database) == [(1, None), (2, None)]


def test_a_file_that_is_gone_stops_a_rewrite_of_its_days(spark, lake):
    root, _ = lake
    land(root, "a.csv", READINGS)
    load(spark, lake)
    os.unlink(os.path.join(root, "raw", "iot_sensors", "a.csv"))
    land(root, "b.csv", ["7,D2,site,z,2024-01-09 10:00:00,20.5,40.0,OK,False"])
    assert load(spark, lake)["sensor_readings"].days == ["2024-01-09"]
    land(root, "c.csv", ["8,D2,site,z,2024-01-01 10:00:00,20.5,40.0,OK,False"])
    with pytest.raises(FileNotFoundError):
        load(spark, lake)


def test_all_sources_in_one_call(spark, lake, small_tables):
    root, database = lake
    adapters.web_log_lines(spark, SMALL).write.text(f"{root}/raw/web_logs")
    sinks.csv_export(adapters.raw_sensor_readings(spark, SMALL), f"{root}/raw/iot_sensors")
    sinks.csv_export(adapters.raw_social_posts(spark, SMALL), f"{root}/raw/social_media", quote_all=True)
    sinks.csv_export(adapters.raw_device_metadata(spark, SMALL), f"{root}/raw/device_metadata")
    done = load(spark, lake, *incremental.SOURCES)
    assert all(d.new for d in done.values())
    for name in catalog.LAYOUTS:
        stored = spark.table(f"{database}.{name}")
        assert same_rows(stored, getattr(small_tables, name).select(*stored.columns)), name
    assert all(d == incremental.Loaded() for d in load(spark, lake, *incremental.SOURCES).values())


def test_a_batch_that_comes_again_leaves_the_tables_as_they_were(spark, lake):
    root, database = lake
    columns = schemas.RAW_SENSOR.names
    def batch(*lines):
        return spark.createDataFrame([line.split(",") for line in lines], schemas.RAW_SENSOR).select(*columns)
    write = ingest.day_replacer("sensor_readings", f"{root}/arrivals", database)
    write(batch(*READINGS), 0)
    second = batch("0,D1,site,z,2024-01-01 10:00:00,9.5,40.0,OK,False", "4,D2,site,z,2024-01-03 11:00:00,9.5,40.0,OK,False")
    for _ in range(2):
        write(second, 1)
        assert ids(spark, database) == [(0, "2024-01-01"), (2, "2024-01-02"), (4, "2024-01-03")]
        assert spark.read.orc(f"{root}/arrivals").count() == 4
    write(second.limit(0), 2)
    assert len(ids(spark, database)) == 3


def test_a_stream_repeats_a_batch_whose_commit_is_lost(spark, lake):
    root, database = lake
    land(root, "a.csv", READINGS)
    def run():
        stream = ingest.raw_stream(spark, "sensor_readings", f"{root}/raw/iot_sensors")
        ingest.replace_days_of(stream, "sensor_readings", f"{root}/arrivals", f"{root}/checkpoint", database, once=True).awaitTermination()
    run()
    before = ids(spark, database)
    for name in os.listdir(f"{root}/checkpoint/commits"):
        os.unlink(f"{root}/checkpoint/commits/{name}")
    run()
    for name in ("sensor_readings", "sensor_daily_summary"):
        spark.catalog.refreshTable(f"{database}.{name}")
    assert ids(spark, database) == before and spark.read.orc(f"{root}/arrivals").count() == 2
    assert spark.table(f"{database}.sensor_daily_summary").agg(F.sum("total_readings")).first()[0] == 2
