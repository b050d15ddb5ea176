"""The streams give what the batch load gives."""

from millrace.plans import curate
from millrace.sources import adapters
from millrace.streaming import ingest

from conftest import SMALL


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_logs(spark, tmp_path, small_tables):
    adapters.web_log_lines(spark, SMALL).write.text(str(tmp_path / "in"))
    stream = ingest.web_traffic(ingest.log_stream(spark, str(tmp_path / "in")))
    for _ in range(2):  # the second run finds nothing new
        ingest.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination(120)
    back = spark.read.orc(str(tmp_path / "out"))
    assert same_rows(back.select(*small_tables.web_traffic.columns), small_tables.web_traffic)


def test_resent_readings_are_dropped(spark, tmp_path, small_tables):
    raw_rows = adapters.raw_sensor_readings(spark, SMALL)
    raw_rows.write.option("header", True).csv(str(tmp_path / "in"))
    stream = ingest.sensor_readings(ingest.sensor_stream(spark, str(tmp_path / "in")))
    ingest.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ("dt", "zone"), once=True).awaitTermination(120)
    back = spark.read.orc(str(tmp_path / "out"))
    keys = ["device_id", "timestamp_ts"]
    assert back.count() == small_tables.sensor_readings.count()
    assert same_rows(back.select(*keys), small_tables.sensor_readings.select(*keys))


def test_hourly_states_are_final_after_the_delay(spark, tmp_path):
    adapters.raw_sensor_readings(spark, SMALL).write.option("header", True).csv(str(tmp_path / "in"))
    states = ingest.hourly_states(ingest.sensor_stream(spark, str(tmp_path / "in")))
    ingest.append_to(states, str(tmp_path / "out"), str(tmp_path / "cp"), (), once=True).awaitTermination(120)
    got = spark.read.orc(str(tmp_path / "out"))
    total = got.agg({"readings": "sum"}).first()[0]
    everything = curate.keyed_readings(adapters.raw_sensor_readings(spark, SMALL)).count()
    # The last open hours stay in the state.
    assert 0 < everything - total < everything * 0.05
    assert got.groupBy("hour_start", "zone").count().filter("count > 1").isEmpty()
