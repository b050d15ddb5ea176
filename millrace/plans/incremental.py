"""The load of what arrived since the last one.

A ledger table holds each landed file that has been loaded: path, size, modification time, and the days its
rows fall on. A load lists the landing folder (names only), scans the files the ledger does not know or knows
with another size or time, and rewrites the days these hold, no others. A day that older files share is built
again from all of its files, so duplicates are settled as in one load of everything, and late rows find their
day. The ledger is written last: a load that fails is repeated as a whole and gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.texts import day, log_time, wall_clock
from ..sources import raw
from ..sources.catalog import LAYOUTS, PROCESSED_DB
from ..sources.sinks import in_parallel, overwrite_table, staged
from . import curate
from .upkeep import drop_partitions

LEDGER = "landed_files"
_LISTED = "file string, bytes long, modified long, path string"
#: Stands for the day of rows whose time cannot be read.
NO_DAY = ""


@dataclass(frozen=True)
class Source:
    """A landing folder, the rows of its files, and the table they feed."""

    folder: str
    read: Callable[[SparkSession, list[str]], DataFrame]
    step: Callable[[DataFrame], DataFrame]
    day: Callable[[], Column] | None = None
    summary: tuple[str, Callable[[DataFrame], DataFrame]] | None = None

    def dated(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_day", F.coalesce(self.day(), F.lit(NO_DAY)))


def _log_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"))
    return raw.parse_log_lines(lines, keep=("_file",))


def _csv_rows(schema) -> Callable[[SparkSession, list[str]], DataFrame]:
    return lambda spark, paths: raw.csv_text(spark.read, paths, schema, escape='"', with_file=True)


SOURCES = {
    "web_traffic": Source("web_logs", _log_rows, curate.web_traffic, lambda: day(log_time(F.col("raw_timestamp")))),
    "sensor_readings": Source("iot_sensors", _csv_rows(schemas.RAW_SENSOR), curate.sensor_readings, lambda: day(wall_clock("ts")),
                              ("sensor_daily_summary", curate.sensor_daily_summary)),
    "social_posts": Source("social_media", lambda spark, paths: raw.quoted_csv(spark, paths, schemas.RAW_SOCIAL, with_file=True), curate.social_posts,
                           lambda: day(wall_clock("ts")), ("trending_hashtags_daily", curate.trending_hashtags_daily)),
    # No days: any new file replaces the registry by all files.
    "device_metadata": Source("device_metadata", _csv_rows(schemas.RAW_DEVICE), curate.device_metadata),
}


@dataclass(frozen=True)
class Loaded:
    """What a load did: files scanned because they are new, files scanned again for their days, days written."""

    new: list[str] = field(default_factory=list)
    again: list[str] = field(default_factory=list)
    days: list[str] = field(default_factory=list)


def create_ledger(spark: SparkSession, database: str = PROCESSED_DB) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{LEDGER} (source STRING, file STRING, path STRING, bytes BIGINT, modified BIGINT, "
        "days ARRAY<STRING>, load BIGINT) USING parquet")


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """file, path, bytes and modified (milliseconds) of each file below a landing folder; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("bytes"),
        F.unix_millis("modificationTime").alias("modified"))


def known(spark: SparkSession, name: str, database: str = PROCESSED_DB) -> DataFrame:
    """The last loaded version of each file of a source."""
    rows = spark.table(f"{database}.{LEDGER}").filter(F.col("source") == name)
    last = F.max_by(F.struct("path", "bytes", "modified", "days", "load"), "load").alias("v")
    return rows.groupBy("file").agg(last).select("file", "v.*")


def fresh(spark: SparkSession, name: str, root: str, database: str = PROCESSED_DB) -> DataFrame:
    """Landed files that are new to the ledger, or changed."""
    there = landed(spark, f"{root}/raw/{SOURCES[name].folder}")
    same = ["file", "bytes", "modified"]
    return there.join(known(spark, name, database).select(*same), same, "left_anti").select(*same, "path")


def replace_days(df: DataFrame, name: str, days: Sequence[str], database: str = PROCESSED_DB, may_shrink: bool = False) -> None:
    """Write the given days of a table.

    ``may_shrink``: partitions of these days that ``df`` no longer holds go. That takes a second run of ``df``,
    so it is asked for only where files were replaced.
    """
    layout, spark = LAYOUTS[name], df.sparkSession
    wanted = df.filter(F.coalesce("dt", F.lit(NO_DAY)).isin(list(days)))
    overwrite_table(wanted, name, database)
    if not may_shrink:
        return
    shown = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.coalesce(F.col(p), F.lit("__HIVE_DEFAULT_PARTITION__"))) for p in layout.partitions])
    held = {r[0] for r in wanted.select(shown).distinct().collect()}  # partitions of the written days
    listed = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {database}.{name}").collect()]
    ours = {f"dt={d or '__HIVE_DEFAULT_PARTITION__'}" for d in days}
    drop_partitions(spark, f"{database}.{name}", [p for p in listed if p.split("/")[0] in ours and p not in held])


def rewrite(rows: DataFrame, name: str, days: Sequence[str], database: str = PROCESSED_DB, may_shrink: bool = False) -> None:
    """Raw rows of whole days to their table and to the daily summary that rests on it."""
    source, spark = SOURCES[name], rows.sparkSession
    replace_days(source.step(rows), name, days, database, may_shrink)
    if source.summary:
        summary, make = source.summary
        stored = spark.table(f"{database}.{name}").filter(F.coalesce("dt", F.lit(NO_DAY)).isin(list(days)))
        replace_days(make(stored), summary, days, database, may_shrink)


def _load_days(spark: SparkSession, name: str, root: str, database: str) -> Loaded:
    source, before = SOURCES[name], known(spark, name, database)
    # File names, as the driver holds them for any scan.
    arrivals = fresh(spark, name, root, database).collect()
    new = [r["path"] for r in arrivals]
    if not new:
        return Loaded()
    entries = spark.createDataFrame(arrivals, _LISTED)
    with staged(source.dated(source.read(spark, new))) as arrived:
        days_of = arrived.groupBy("_file").agg(F.collect_set("_day").alias("days"))
        replaced = before.join(entries.select("file"), "file", "left_semi")
        gone = [r[0] for r in replaced.select(F.explode("days")).distinct().collect()]
        days = sorted({r[0] for r in arrived.select("_day").distinct().collect()} | set(gone))  # calendar days
        shared = before.join(entries.select("file"), "file", "left_anti").filter(F.arrays_overlap("days", F.array(*map(F.lit, days)).cast("array<string>")))
        there = landed(spark, f"{root}/raw/{source.folder}").select("file", F.col("path").alias("_there"))
        again = shared.join(there, "file", "left").select("path", "_there").collect()
        missing = [r["path"] for r in again if r["_there"] is None]
        if missing:
            raise FileNotFoundError(f"{name}: days to rewrite also lie in files that are gone: {missing[:3]}")
        again = [r["path"] for r in again]
        rows = arrived
        if again:
            rows = rows.unionByName(source.dated(source.read(spark, again)).filter(F.col("_day").isin(days)))
        rewrite(rows.drop("_file", "_day"), name, days, database, may_shrink=bool(gone))
        _record(entries.join(days_of, F.col("file") == F.col("_file"), "left"), name, database)
    return Loaded(sorted(new), sorted(again), days)


def _load_whole(spark: SparkSession, name: str, root: str, database: str) -> Loaded:
    source = SOURCES[name]
    arrivals = fresh(spark, name, root, database).collect()
    if not arrivals:
        return Loaded()
    every = [r["path"] for r in landed(spark, f"{root}/raw/{source.folder}").select("path").collect()]
    overwrite_table(source.step(source.read(spark, every).drop("_file")), name, database)
    entries = spark.createDataFrame(arrivals, _LISTED)
    _record(entries.withColumn("days", F.array().cast("array<string>")), name, database)
    new = [r["path"] for r in arrivals]
    return Loaded(sorted(new), sorted(set(every) - set(new)))


def _record(entries: DataFrame, name: str, database: str) -> None:
    spark = entries.sparkSession
    last = spark.table(f"{database}.{LEDGER}").filter(F.col("source") == name).agg(F.max("load")).first()[0] or 0
    days = F.coalesce("days", F.array().cast("array<string>")).alias("days")
    rows = entries.select(F.lit(name).alias("source"), "file", "path", "bytes", "modified", days, F.lit(last + 1).cast("long").alias("load"))
    rows.coalesce(1).write.insertInto(f"{database}.{LEDGER}")  # one row per landed file


def load_new_files(
    spark: SparkSession, root: str, database: str = PROCESSED_DB, names: Sequence[str] = tuple(SOURCES),
) -> dict[str, Loaded]:
    """Bring the tables up to date with ``<root>/raw``; returns what was scanned and written for each."""
    create_ledger(spark, database)
    done: dict[str, Loaded] = {}

    def one(name: str) -> None:
        load = _load_days if SOURCES[name].day else _load_whole
        done[name] = load(spark, name, root, database)

    in_parallel([lambda name=name: one(name) for name in names])
    return {name: done[name] for name in names}
