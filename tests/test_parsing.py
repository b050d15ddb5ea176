"""Log lines, CSV files and typing on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.measures import half_up
from millrace.functions.texts import hashtag_tokens, log_time
from millrace.plans import curate
from millrace.sources import raw, sinks

GOOD = '10.0.0.1 - - [01/Jan/2024:12:00:01 +0000] "GET /a?x=1?y=2 HTTP/1.1" 200 512 "-" "Mozilla/5.0 (X11)"'


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_fields_of_a_good_line(spark):
    row = raw.parse_log_lines(lines(spark, GOOD)).first()
    assert row.asDict() == {
        "client_ip": "10.0.0.1", "rfc_ident": None, "auth_user": None,
        "raw_timestamp": "01/Jan/2024:12:00:01 +0000", "http_request": "GET /a?x=1?y=2 HTTP/1.1",
        "http_status": 200, "response_bytes": "512", "referrer": "-", "user_agent": "Mozilla/5.0 (X11)",
    }


@pytest.mark.parametrize("bad", ["", "garbage", GOOD + " tail", GOOD[:-1], GOOD.replace("[", "")])
def test_broken_line_is_all_null(spark, bad):
    row = raw.parse_log_lines(lines(spark, bad)).first()
    assert set(row) == {None}


def test_empty_fields_are_kept(spark):
    row = raw.parse_log_lines(lines(spark, GOOD.replace('"-"', '""').replace('"Mozilla/5.0 (X11)"', '""'))).first()
    assert (row.referrer, row.user_agent) == ("", "")


def test_status_that_is_no_number_drops_the_row(spark):
    parsed = raw.parse_log_lines(lines(spark, GOOD.replace(" 200 ", " OK "), GOOD, "garbage"))
    assert parsed.filter("client_ip is not null and http_status is null").count() == 1
    assert curate.web_traffic(parsed).count() == 1


def test_rows_in_are_rows_out_plus_rejected(spark):
    parsed = raw.parse_log_lines(lines(spark, GOOD, GOOD, "x", GOOD.replace(" 200 ", " - ")))
    kept = curate.web_traffic(parsed).count()
    rejected = parsed.filter("client_ip is null or http_request is null or http_status is null").count()
    assert (kept, rejected, parsed.count()) == (2, 2, 4)


def test_request_parts(spark):
    row = curate.web_traffic(raw.parse_log_lines(lines(spark, GOOD))).first()
    assert (row.http_method, row.url_path, row.url_query, row.http_protocol) == ("GET", "/a", "x=1", "HTTP/1.1")
    assert (row.request_hour, row.request_dow, row.dt) == (12, 2, "2024-01-01")
    assert row.request_ts == dt.datetime(2024, 1, 1, 12, 0, 1)


def test_no_query_and_no_body(spark):
    line = GOOD.replace("/a?x=1?y=2", "/a").replace(" 512 ", " - ")
    row = curate.web_traffic(raw.parse_log_lines(lines(spark, line))).first()
    assert (row.url_query, row.response_bytes, row.referrer) == ("", 0, "-")


def test_zone_offset_is_applied_whatever_the_session_zone(spark):
    df = lines(spark, "31/Dec/2023:23:30:00 -0100", "bad")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(log_time(F.col("value"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 1, 1, 0, 30), None]


def test_line_is_matched_once(spark):
    """Later filters and columns must not repeat the pattern."""
    traffic = curate.web_traffic(raw.parse_log_lines(lines(spark, GOOD)))
    assert traffic._jdf.queryExecution().executedPlan().toString().count("regexp_replace") == 1


def test_clf_scan_reads_a_folder(spark, tmp_path):
    (tmp_path / "a.log").write_text(GOOD + "\nbroken\n")
    (tmp_path / "b.log").write_text(GOOD + "\n")
    assert raw.scan_clf(spark, str(tmp_path)).filter("client_ip is not null").count() == 2


def test_sensor_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "reading_id,device_id,location,zone,timestamp,temperature,humidity,status,is_duplicate\n"
        "1,D1,B,lab,2024-01-15 09:30:00,21.5,45.2,OK,False\n"
        '2,D1,"B, north",lab,2024-01-15 09:31:00,,,MISSING,True\n'
    )
    rows = raw.type_sensor(raw.scan_sensor_csv(spark, str(tmp_path))).orderBy("reading_id").collect()
    assert [r.ts for r in rows] == ["2024-01-15 09:30:00", "2024-01-15 09:31:00"]
    assert (rows[1].temperature, rows[1].humidity, rows[1].is_duplicate, rows[1].location) == (None, None, True, "B, north")


def test_blank_is_text_and_short_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "s.csv").write_text("h\n1,D1,,lab,2024-01-15 09:30:00,,\"\",OK,False\n2,D2\n")
    (row,) = raw.scan_sensor_csv(spark, str(tmp_path)).collect()
    assert (row.location, row.temperature, row.humidity) == ("", "", "")
    (short,) = raw.scan_sensor_csv(spark, str(tmp_path), short=True).collect()
    assert (short.device_id, short.ts, short.status) == ("D2", None, None)
    kept = curate.sensor_readings(raw.scan_sensor_csv(spark, str(tmp_path)))
    assert [r.reading_id for r in kept.collect()] == [1]


def test_header_can_be_absent(spark, tmp_path):
    (tmp_path / "s.csv").write_text("1,D1,B,lab,2024-01-15 09:30:00,21.5,45.2,OK,False\n")
    assert raw.scan_sensor_csv(spark, str(tmp_path), header=False).count() == 1


def test_social_csv_with_doubled_quotes(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        '"tweet_id","username","user_type","followers","verified","timestamp","text","hashtags","likes","retweets",'
        '"replies","impressions","language","source"\n'
        '"1","u","nano","10","True","2024-01-15 09:30:00","he said ""hi"", twice","#a #b","1","2","3","4","en","web"\n'
    )
    row = raw.type_social(raw.scan_social_csv(spark, str(tmp_path), escape='"')).first()
    assert (row.post_text, row.likes, row.verified) == ('he said "hi", twice', 1, True)


def test_device_csv_types(spark, tmp_path):
    names = raw.schemas.RAW_DEVICE.names
    values = dict.fromkeys(names, "x") | {
        "latitude": "1.5", "longitude": "2", "install_date": "2024-01-02", "last_maintenance": "",
        "battery_level_pct": "", "sampling_interval_sec": "60", "alert_temp_min": "1", "alert_temp_max": "2",
        "alert_humidity_min": "3", "alert_humidity_max": "4", "active": "True",
    }
    (tmp_path / "d.csv").write_text(",".join(names) + "\n" + ",".join(values.values()) + "\n")
    row = curate.device_metadata(raw.scan_device_csv(spark, str(tmp_path))).first()
    assert row.battery_level_pct is None and row.last_maintenance is None
    assert (row.install_date, row.sampling_interval_sec, row.active) == (dt.date(2024, 1, 2), 60, True)


def test_hashtag_tokens(spark):
    df = spark.createDataFrame([("",), ("  #a   #b ",), (None,)], "h string")
    got = [r[0] for r in df.select(hashtag_tokens(F.col("h"))).collect()]
    assert got == [[""], ["#a", "#b"], None]


def test_quotes_and_line_breaks_come_back(spark, tmp_path):
    device = spark.createDataFrame([("D1", 'Probe "north", 2')], "device_id string, device_name string")
    names = raw.schemas.RAW_DEVICE.names
    row = device.select(*[F.col(c) if c in device.columns else F.lit("").alias(c) for c in names])
    sinks.csv_export(row, str(tmp_path / "devices"))
    assert raw.scan_device_csv(spark, str(tmp_path / "devices")).first().device_name == 'Probe "north", 2'
    names = raw.schemas.RAW_SOCIAL.names
    post = spark.range(1).select(*[F.lit('two\nlines, "quoted"' if c == "post_text" else "1").alias(c) for c in names])
    sinks.csv_export(post, str(tmp_path / "posts"), quote_all=True)
    (read,) = raw.scan_social_csv(spark, str(tmp_path / "posts")).collect()
    assert read.post_text == 'two\nlines, "quoted"' and getattr(read, names[-1]) == "1"


@pytest.mark.parametrize("value, digits, rounded", [(2.49996, 0, 2.0), (0.1249999, 2, 0.12), (0.125, 2, 0.13), (-0.125, 2, -0.13), (0.12499999999999999, 2, 0.13), (2.5, 0, 3.0)])
def test_means_are_rounded_once(spark, value, digits, rounded):
    assert spark.range(1).select(half_up(F.lit(value), digits)).first()[0] == rounded
