"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MAP_JOIN_LIMIT = 25_000_000
TARGET_FILE_BYTES = 256 * 1024 * 1024

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Replace only the partitions a result holds, never the other days.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # dt stays text: '2024-01-15' must not turn into a DATE.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Spark checks the size before it broadcasts; beyond it the join shuffles.
    "spark.sql.autoBroadcastJoinThreshold": str(MAP_JOIN_LIMIT),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys also where a grouping on the key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_FILE_BYTES),
    "spark.sql.files.maxPartitionBytes": str(TARGET_FILE_BYTES),
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.statistics.size.autoUpdate.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    # A bucketed scan runs one task per bucket, 16 or 32 for any amount of data.
    # Splitting the files freely and shuffling the small partial aggregates is
    # the better plan; see bucketed_scans for joins that gain from buckets.
    "spark.sql.sources.bucketing.enabled": "false",
}


def build_session(app_name: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above.

    ``extra`` holds further settings with ``__`` for dots, for example
    ``spark__sql__shuffle__partitions="8"``. Cluster size, memory and the
    number of shuffle partitions belong to the deployment and are not set here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with about one partition per 256 MB of input.

    The default of 200 would put half a terabyte of a 100 TB load into each.
    The runtime joins partitions that turn out small, so too many cost little.
    """
    wanted = -(-input_bytes // TARGET_FILE_BYTES)
    number = max(spark.sparkContext.defaultParallelism, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


@contextmanager
def bucketed_scans(spark: SparkSession) -> Iterator[None]:
    """Plan queries inside by buckets, to join two large tables bucketed alike without a shuffle."""
    key = "spark.sql.sources.bucketing.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: Spark keeps the rows in the shared folder until nothing refers to them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (a local run, a test) a new temporary folder takes its place.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_FOLDERS[context.applicationId]
