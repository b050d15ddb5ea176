"""The load as streams over the landing folders.

The landing zone only ever gains files, so the batch steps carry over: the
same parsing and scoring run on each new file. ``append_to`` adds rows as they
come; ``replace_days_of`` keeps the tables as a batch load would leave them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.measures import count_where, rows
from ..functions import fixed_values as V
from ..plans import curate, incremental
from ..sources.catalog import PROCESSED_DB
from ..sources.raw import csv_text, parse_log_lines
from ..sources.sinks import overwrite_path


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path)


def sensor_stream(spark: SparkSession, path: str) -> DataFrame:
    return csv_text(spark.readStream, path, schemas.RAW_SENSOR)


def post_stream(spark: SparkSession, path: str) -> DataFrame:
    """Posts with line breaks; a landed file is one task here."""
    return csv_text(spark.readStream, path, schemas.RAW_SOCIAL, escape='"', multi_line=True)


def raw_stream(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The raw rows that feed a table with days."""
    match name:
        case "web_traffic":
            return parse_log_lines(log_stream(spark, path))
        case "sensor_readings":
            return csv_text(spark.readStream, path, schemas.RAW_SENSOR, escape='"')
        case "social_posts":
            return post_stream(spark, path)
    raise KeyError(name)


def web_traffic(lines: DataFrame) -> DataFrame:
    """Parsing keeps no state: every line stands for itself."""
    return curate.web_traffic(parse_log_lines(lines))


def sensor_readings(raw: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Scored readings, each device and time once.

    Of a reading sent twice the first to arrive stays, if the second comes
    within ``delay``; the state is dropped after that.
    """
    keyed = curate.keyed_readings(raw).withColumn("event_time", F.col("ts").try_cast("timestamp"))
    once = keyed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["device_id", "ts"])
    return curate.scored_readings(once)


def hourly_states(raw: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Readings, each counted once, and anomalies per zone and hour; an hour is final once ``delay`` has passed."""
    timed = curate.keyed_readings(raw).withColumn("event_time", F.col("ts").try_cast("timestamp"))
    return (
        timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["device_id", "ts"])
        .groupBy(F.window("event_time", "1 hour").alias("hour"), "zone")
        .agg(rows().alias("readings"), count_where(F.col("status") == V.STATUS_ANOMALY).alias("anomalies"))
        .select(F.col("hour.start").alias("hour_start"), "zone", "readings", "anomalies")
    )


def append_to(
    stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ("dt",), once: bool = False
) -> StreamingQuery:
    """Append to an ORC folder; each input file counts exactly once.

    ``checkpoint`` must lie in shared storage. ``once`` works off what is there and stops.
    """
    writer = (
        stream.writeStream.format("orc").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def day_replacer(name: str, arrivals: str, database: str = PROCESSED_DB) -> Callable[[DataFrame, int], None]:
    """A step for ``foreachBatch`` that leaves the tables as a batch load of all arrived rows would.

    Raw rows are kept in ``arrivals`` by day and batch, and each day a batch touches is built from all its
    arrivals: duplicates from different batches meet, late rows find their day, and the daily summary follows.
    A batch that comes again, after a failure, replaces its own arrivals and writes the same days once more.
    """
    source = incremental.SOURCES[name]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        dated = source.dated(batch).withColumn("arrival_day", F.nullif("_day", F.lit(incremental.NO_DAY))).drop("_day")
        overwrite_path(dated.withColumn("arrival_batch", F.lit(number).cast("long")), arrivals, ["arrival_day", "arrival_batch"])
        schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in batch.schema)}, arrival_day string, arrival_batch long"
        kept = spark.read.schema(schema).orc(arrivals).withColumn("arrival_day", F.coalesce("arrival_day", F.lit(incremental.NO_DAY)))
        days = [r[0] for r in kept.filter(F.col("arrival_batch") == number).select("arrival_day").distinct().collect()]  # calendar days
        if days:
            rows = kept.filter(F.col("arrival_day").isin(days)).select(*batch.columns)
            incremental.rewrite(rows, name, days, database)

    return write


def replace_days_of(
    stream: DataFrame, name: str, arrivals: str, checkpoint: str, database: str = PROCESSED_DB, once: bool = False,
) -> StreamingQuery:
    """Feed a table with days, and its daily summary, from raw rows; see ``day_replacer``.

    ``arrivals`` and ``checkpoint`` must lie in shared storage. ``once`` works off what is there and stops.
    The stream writes in a session of its own: one that read the tables before calls ``refreshTable``.
    """
    writer = stream.writeStream.foreachBatch(day_replacer(name, arrivals, database)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
