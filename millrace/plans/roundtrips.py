"""Sources and sinks as queries: write to the shared folder, read back.

What is read back is checkpointed, so the written files can go at once; Spark
drops a checkpoint when nothing refers to it any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.measures import rows
from ..operators import sampling, statistics
from ..session import bucketed_scans, checkpointed
from ..sources import archive, catalog, files, raw, sinks
from ..sources.split_insert import Branch, split_insert
from ..streaming import ingest
from ..tables import Tables
from . import compaction, curate, incremental, upkeep, web


def log_files(lines: DataFrame) -> DataFrame:
    """Log lines as text files, through the log scan."""
    with sinks.staging_folder(lines.sparkSession, "logs") as path:
        lines.write.text(path)
        return checkpointed(raw.scan_clf(lines.sparkSession, path))


def sensor_csv(raw_readings: DataFrame) -> DataFrame:
    with sinks.staging_folder(raw_readings.sparkSession, "sensors") as path:
        sinks.csv_export(raw_readings, path)
        return checkpointed(raw.type_sensor(raw.scan_sensor_csv(raw_readings.sparkSession, path)))


def social_csv(raw_posts: DataFrame) -> DataFrame:
    """Posts with their line breaks and doubled quotes."""
    with sinks.staging_folder(raw_posts.sparkSession, "posts") as path:
        sinks.csv_export(raw_posts, path, quote_all=True)
        return checkpointed(raw.type_social(raw.scan_social_csv(raw_posts.sparkSession, path)))


def device_csv(raw_devices: DataFrame) -> DataFrame:
    with sinks.staging_folder(raw_devices.sparkSession, "devices") as path:
        sinks.csv_export(raw_devices, path)
        typed = raw.type_device(raw.scan_device_csv(raw_devices.sparkSession, path))
        return checkpointed(typed.withColumns({c: F.col(c).cast("string") for c in ("install_date", "last_maintenance")}))


def partition_overwrite(t: Tables) -> DataFrame:
    """All days of web traffic, then one day again without its failed requests: the others stay."""
    traffic = t.web_traffic.select("client_ip", "http_status", "response_bytes", "request_ts", "dt")
    with sinks.staging_folder(traffic.sparkSession, "traffic") as path:
        sinks.overwrite_path(traffic, path, ["dt"])
        one_day = traffic.filter((F.col("dt") == "2024-01-15") & (F.col("http_status") < 400))
        sinks.overwrite_path(one_day, path, ["dt"])
        return checkpointed(traffic.sparkSession.read.schema(traffic.schema).orc(path))


def tsv_report(t: Tables) -> DataFrame:
    """The hourly traffic report as a TSV folder, read back."""
    report = web.hourly_path_status(t)
    with sinks.staging_folder(report.sparkSession, "report") as path:
        sinks.csv_export(report, path, sep="\t")
        return checkpointed(report.sparkSession.read.schema(report.schema).option("header", True).option("sep", "\t").csv(path))


# -- tables ------------------------------------------------------------


@contextmanager
def _scratch(spark: SparkSession, bucketed: bool = True) -> Iterator[str]:
    """A database with empty processed tables; it goes when the block ends."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    with sinks.staging_folder(spark, "tables") as folder:
        catalog.create_database(spark, name, folder, "round trip", {"layer": "scratch"})
        try:
            catalog.create_processed_tables(spark, name, bucketed)
            yield name
        finally:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def plain_dates(devices: DataFrame) -> DataFrame:
    return devices.withColumns({c: F.col(c).cast("string") for c in ("install_date", "last_maintenance")})


def written_table(t: Tables, name: str) -> DataFrame:
    """A processed table written by its layout and read back."""
    df = getattr(t, name)
    with _scratch(df.sparkSession) as database:
        sinks.overwrite_table(df, name, database)
        return checkpointed(df.sparkSession.table(f"{database}.{name}"))


def replaced_registry(t: Tables) -> DataFrame:
    """The device registry written over one that held half of it."""
    df = t.device_metadata
    with _scratch(df.sparkSession) as database:
        sinks.overwrite_table(df.filter("active"), "device_metadata", database)
        sinks.overwrite_table(df, "device_metadata", database)
        return checkpointed(plain_dates(df.sparkSession.table(f"{database}.device_metadata")))


def several_tables(t: Tables) -> DataFrame:
    """Readings and their summary from one source computed once; rows of both tables by day."""
    spark = t.sensor_readings.sparkSession
    with _scratch(spark) as database:
        sinks.multi_insert(
            t.sensor_readings, [(lambda df: df, "sensor_readings"), (curate.sensor_daily_summary, "sensor_daily_summary")], database)
        readings = spark.table(f"{database}.sensor_readings").groupBy("dt").agg(rows().alias("readings"))
        summaries = spark.table(f"{database}.sensor_daily_summary").groupBy("dt").agg(rows().alias("summaries"))
        return checkpointed(readings.join(summaries, "dt", "left").fillna(0, ["summaries"]))


def sampled_bucket_files(t: Tables, of: int = 4) -> DataFrame:
    """All samples of one bucket, each from its own files: together every row once."""
    spark = t.web_traffic.sparkSession
    with _scratch(spark) as database:
        sinks.overwrite_table(t.web_traffic, "web_traffic", database)
        table, found = f"{database}.web_traffic", None
        for bucket in range(1, of + 1):
            own = sampling.table_bucket_sample(spark, table, bucket, of).groupBy("client_ip").agg(rows().alias("requests"))
            found = own if found is None else found.unionByName(own)
        return checkpointed(found)


def merged_profile(t: Tables, columns: Sequence[str]) -> DataFrame:
    """Statistics kept by day, one day replaced, merged; and whether the estimates are near."""
    readings = t.sensor_readings
    spark = readings.sparkSession
    with sinks.staging_folder(spark, "statistics") as path:
        sinks.overwrite_path(statistics.daily_statistics(readings, columns), path, ["dt"])
        one_day = readings.filter(F.col("dt") == readings.agg(F.min("dt")).first()[0])
        sinks.overwrite_path(statistics.daily_statistics(one_day, columns), path, ["dt"])
        merged = checkpointed(statistics.merged_statistics(spark.read.orc(path)))
    exact = readings.agg(*[F.countDistinct(c).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "distinct_values")
    near = F.abs(F.col("approx_distinct") - F.col("distinct_values")) <= F.greatest(F.col("distinct_values") * statistics.SKETCH_ERROR, F.lit(1.0))
    return merged.join(exact, "column_name").withColumn("estimate_is_near", near).drop("approx_distinct")


def delimited_report(t: Tables) -> DataFrame:
    """The hourly traffic report without header or compression, read back."""
    report = web.hourly_path_status(t)
    with sinks.staging_folder(report.sparkSession, "delimited") as path:
        sinks.delimited_folder(report, path)
        return checkpointed(report.sparkSession.read.schema(report.schema).csv(path))


def archived_logs(lines: DataFrame) -> DataFrame:
    """Log files archived under a day and scanned there."""
    spark = lines.sparkSession
    with sinks.staging_folder(spark, "archive") as path:
        lines.write.text(f"{path}/web")
        return checkpointed(raw.scan_clf(spark, sinks.archive_snapshot(spark, f"{path}/web", f"{path}/old", "2024-01-31", "web_logs")))


def archived_additions(lines: DataFrame) -> DataFrame:
    """Log files of two days, archived after each, brought back from the second snapshot and scanned.

    ``only_new_copied`` tells whether the second snapshot copied the second day's files alone.
    """
    spark = lines.sparkSession
    with sinks.staging_folder(spark, "archive") as path:
        copied = []
        for (portion, rows), day in zip(_portions(lines), ("2024-01-30", "2024-01-31"), strict=True):
            rows.write.text(f"{path}/web/{portion}")
            copied.append(archive.snapshot(spark, f"{path}/web", f"{path}/old", "web_logs", day))
        only_new = copied[1].filter(~F.col("name").startswith("second/")).isEmpty() and not copied[1].isEmpty()
        archive.restore(spark, f"{path}/old", "web_logs", "2024-01-31", f"{path}/back")
        return checkpointed(raw.scan_clf(spark, f"{path}/back/*").withColumn("only_new_copied", F.lit(only_new)))


def readings_by_outcome(t: Tables) -> DataFrame:
    """Readings dealt in one pass to three tables: all, anomalies with a label, missing; rows of each by day and zone."""
    readings = t.sensor_readings
    spark, names = readings.sparkSession, ("readings", "anomalies", "missing")
    with _scratch(spark, bucketed=False) as database:
        for name in names:
            label = ", label STRING" if name == "anomalies" else ""
            spark.sql(f"CREATE TABLE {database}.{name} (reading_id STRING, device_id STRING, temperature DOUBLE{label}, dt STRING, zone STRING) "
                      "USING orc PARTITIONED BY (dt, zone)")
        source = readings.withColumn("reading_id", F.col("reading_id").cast("string"))
        split_insert(source, [
            Branch(f"{database}.readings"),
            Branch(f"{database}.anomalies", F.col("status") == "ANOMALY", {"label": F.concat_ws("/", "zone", "device_id")}),
            Branch(f"{database}.missing", F.col("status") == "MISSING"),
        ])
        counted = [
            spark.table(f"{database}.{n}").groupBy("dt", "zone").agg(rows().alias("n"), F.countDistinct("device_id").alias("devices"))
            .select(F.lit(n).alias("target"), "*") for n in names
        ]
        return checkpointed(counted[0].unionByName(counted[1]).unionByName(counted[2]))


def compacted_table(t: Tables) -> DataFrame:
    """Readings in large and small files, joined by the planner: the rows, and whether the files are as planned.

    ``large_files_kept``: every file over the limit is still there. ``files_as_planned``:
    the number of files fell by the joined ones less one for each group.
    """
    readings = t.sensor_readings
    spark = readings.sparkSession
    with _scratch(spark, bucketed=False) as database:
        table = f"{database}.sensor_readings"
        (_, most), (_, rest) = _portions(readings.withColumn("_key", F.col("reading_id").cast("string")).select("_key", *readings.columns))
        sinks.overwrite_table(most, "sensor_readings", database)
        listing = files.listed(spark, files.table_folder(spark, table))
        limit = int(listing.agg(F.percentile_approx("bytes", 0.5)).first()[0])  # half of these files count as large
        rest.select(*spark.table(table).columns).repartition(3).write.insertInto(table)
        before = checkpointed(files.listed(spark, files.table_folder(spark, table)))
        planned = checkpointed(compaction.plan_compaction(spark, table, small_bytes=limit))
        groups = planned.select("folder", "bucket", "bin").distinct().count()
        done = compaction.compact_table(spark, "sensor_readings", database, small_bytes=limit)
        after = files.listed(spark, files.table_folder(spark, table))
        kept = before.filter(F.col("bytes") >= limit).join(after, ["path", "bytes", "modified"], "left_anti").isEmpty()
        as_planned = groups > 0 and done.groups == groups and after.count() == before.count() - planned.count() + groups
        found = spark.table(table).withColumns({"large_files_kept": F.lit(kept), "files_as_planned": F.lit(as_planned)})
        return checkpointed(found)


def compacted_readings(t: Tables, day: str = "2024-01-03", zone: str = "zone-5") -> DataFrame:
    """Readings with one partition in small files, compacted: the rows stay."""
    spark = t.sensor_readings.sparkSession
    with _scratch(spark) as database:
        table = f"{database}.sensor_readings"
        sinks.overwrite_table(t.sensor_readings, "sensor_readings", database)
        part = checkpointed(spark.table(table).filter((F.col("dt") == day) & (F.col("zone") == zone)))
        part.repartition(8).write.insertInto(table, overwrite=True)
        upkeep.compact_partition(spark, "sensor_readings", {"dt": day, "zone": zone}, database)
        return checkpointed(spark.table(table))


def pruned_traffic(t: Tables, as_of: str = "2024-01-20", days: int = 10) -> DataFrame:
    """Web traffic without the days that retention drops."""
    spark = t.web_traffic.sparkSession
    with _scratch(spark) as database:
        sinks.overwrite_table(t.web_traffic, "web_traffic", database)
        upkeep.prune_partitions(spark, "web_traffic", as_of, database, days)
        return checkpointed(spark.table(f"{database}.web_traffic"))


def bucketed_join(t: Tables) -> DataFrame:
    """Readings per tier from two tables bucketed alike, joined without a shuffle."""
    spark = t.sensor_readings.sparkSession
    with _scratch(spark) as database:
        for name, df in (("facts", t.sensor_readings.select("device_id")), ("dims", t.device_metadata.select("device_id", "sla_tier"))):
            df.write.bucketBy(16, "device_id").sortBy("device_id").saveAsTable(f"{database}.{name}")
        with bucketed_scans(spark):
            joined = spark.table(f"{database}.facts").join(spark.table(f"{database}.dims").hint("merge"), "device_id")
            return checkpointed(joined.groupBy("sla_tier").agg(rows().alias("readings")))


# -- loads of what arrived ---------------------------------------------


def _land(rows: DataFrame, folder: str, portion: str) -> None:
    """Raw rows as landed files: lines as text, the rest as CSV."""
    if rows.columns == ["value"]:
        rows.write.text(f"{folder}/{portion}")
    else:
        sinks.csv_export(rows, f"{folder}/{portion}", quote_all=True)


def _portions(rows: DataFrame) -> list[tuple[str, DataFrame]]:
    """Two thirds and one third of raw rows by a hash of the first column: most days lie in both."""
    last = F.crc32(F.col(rows.columns[0]).cast("binary")) % 3 == 0
    return [("first", rows.filter(~last)), ("second", rows.filter(last))]


def loaded_by_new_files(raw_rows: DataFrame, name: str, result: str | None = None) -> DataFrame:
    """A table after two loads of new files: one load of everything would give the same."""
    spark = raw_rows.sparkSession
    with sinks.staging_folder(spark, "landing") as root, _scratch(spark, bucketed=False) as database:
        for portion, rows in _portions(raw_rows):
            _land(rows, f"{root}/raw/{incremental.SOURCES[name].folder}", portion)
            incremental.load_new_files(spark, root, database, [name])
        return checkpointed(spark.table(f"{database}.{result or name}"))


def streamed_by_days(raw_rows: DataFrame, name: str, result: str | None = None) -> DataFrame:
    """A table after two runs of the stream that replaces days."""
    spark = raw_rows.sparkSession
    with sinks.staging_folder(spark, "stream") as root, _scratch(spark, bucketed=False) as database:
        for portion, rows in _portions(raw_rows):
            _land(rows, f"{root}/in", portion)
            stream = ingest.raw_stream(spark, name, f"{root}/in/*")
            ingest.replace_days_of(stream, name, f"{root}/arrivals", f"{root}/checkpoint", database, once=True).awaitTermination()
        return checkpointed(spark.table(f"{database}.{result or name}"))


@contextmanager
def _blocks_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Let a task read so many bytes of a file."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def social_csv_in_blocks(raw_posts: DataFrame) -> DataFrame:
    """Posts from one file that several tasks read."""
    spark = raw_posts.sparkSession
    with sinks.staging_folder(spark, "posts") as path, _blocks_of(spark, 256 * 1024):
        sinks.csv_export(raw_posts, path, quote_all=True, single_file=True)
        return checkpointed(raw.type_social(raw.scan_social_csv(spark, path)))
