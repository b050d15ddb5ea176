"""CSV files cut into blocks against the reader that takes a file as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.sources import adapters, raw, sinks, split_csv

from conftest import SMALL

NAMES = schemas.RAW_SOCIAL.names


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def blocks(spark):
    """Make tasks read so many bytes of a file."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def size(n):
        for k in keys:
            spark.conf.set(k, str(n))

    yield size
    for k, v in before.items():
        spark.conf.set(k, v)


def quoted(value, rng):
    plain = not any(c in value for c in '",\r\n') and value == value.strip() and value
    return value if plain and rng.random() < 0.5 else '"' + value.replace('"', '""') + '"'


def write(path, rows, rng, end="\n", header=True):
    out = [",".join(NAMES)] if header else []
    out += [",".join(quoted(v, rng) for v in row) for row in rows]
    path.write_bytes((end.join(out) + end).encode())


def posts(n, rng):
    pieces = ["word", 'say ""', '"', "\n", "\r\n", "\n\n", ",", "é", " ", '",\n"', ""]
    return [[str(i), *("".join(rng.choice(pieces) for _ in range(rng.randrange(9))) for _ in NAMES[2:]), "end"] for i in range(n)]


@pytest.mark.parametrize("size", [64, 1_000, 1 << 20])
def test_cut_files_hold_the_same_rows(spark, tmp_path, blocks, size):
    rng = random.Random(size)
    for i, end in enumerate(("\n", "\r\n")):
        write(tmp_path / f"{i}.csv", posts(60, rng), rng, end)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text(",".join(NAMES) + "\n")
    whole = raw.csv_text(spark.read, str(tmp_path), schemas.RAW_SOCIAL, escape='"', multi_line=True)
    want = sorted(map(tuple, whole.collect()))
    blocks(size)
    read = split_csv.lines(spark, str(tmp_path))
    if size < 1_000_000:
        assert read.select("file", "block").distinct().count() > 8
    got = sorted(map(tuple, raw.quoted_csv(spark, str(tmp_path), schemas.RAW_SOCIAL).collect()))
    assert len(got) == 120 and got == want


def test_a_record_over_many_blocks(spark, tmp_path, blocks):
    blocks(50)
    rng = random.Random(1)
    rows = [["1", *["x"] * 5, "a\n" * 300, *["y"] * 7], ["2", *["x"] * 5, "b", *["y"] * 7], ["3", *["x"] * 5, 'q""\n' * 80, *["y"] * 7]]
    write(tmp_path / "p.csv", rows, rng)
    got = {r["tweet_id"]: r["post_text"] for r in raw.scan_social_csv(spark, str(tmp_path)).collect()}
    assert got == {r[0]: r[6] for r in rows}


def test_one_file_is_read_by_several_tasks(spark, tmp_path, blocks):
    given = adapters.raw_social_posts(spark, SMALL)
    sinks.csv_export(given.coalesce(1), str(tmp_path / "p"), quote_all=True)
    blocks(64 * 1024)
    scanned = raw.scan_social_csv(spark, str(tmp_path / "p"))
    assert scanned.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    assert same_rows(scanned, given)


def test_no_header_short_records_and_blank_lines(spark, tmp_path):
    row = ",".join(["7", *["v"] * 13])
    (tmp_path / "p.csv").write_text(f"﻿{row}\n\n8,too,short\n\r\n{row}")
    read = raw.quoted_csv(spark, str(tmp_path), schemas.RAW_SOCIAL, header=False)
    assert [r["tweet_id"] for r in read.collect()] == ["7", "7"]
    (short,) = raw.quoted_csv(spark, str(tmp_path), schemas.RAW_SOCIAL, header=False, short=True).collect()
    assert short["tweet_id"] == "8" and short["user_type"] == "short"


def test_a_quote_that_never_closes_takes_the_rest(spark, tmp_path, blocks):
    blocks(40)
    (tmp_path / "p.csv").write_text(",".join(NAMES) + "\n" + ",".join(["1", *["v"] * 13]) + '\n2,"open\nline\nline\n' + "x\n" * 50)
    assert split_csv.records(spark, str(tmp_path)).count() == 3


def test_files_cut_differently_are_an_error():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a"]), pa.array(["f"]), pa.array([7]), pa.array([None], pa.bool_())], ["value", "file", "block", "inside"])
    with pytest.raises(ValueError):
        list(split_csv._cut(iter([batch])))
