"""The processed tables a plan reads, from whatever holds them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .plans import curate
from .sources import adapters, raw


class Tables:
    """Lazy access to the processed tables by attribute."""

    def __init__(self, read: Callable[[str], DataFrame]):
        self._read = read

    @cached_property
    def web_traffic(self) -> DataFrame:
        return self._read("web_traffic")

    @cached_property
    def sensor_readings(self) -> DataFrame:
        return self._read("sensor_readings")

    @cached_property
    def social_posts(self) -> DataFrame:
        return self._read("social_posts")

    @cached_property
    def device_metadata(self) -> DataFrame:
        return self._read("device_metadata")

    @cached_property
    def sensor_daily_summary(self) -> DataFrame:
        return self._read("sensor_daily_summary")

    @cached_property
    def trending_hashtags_daily(self) -> DataFrame:
        return self._read("trending_hashtags_daily")


def catalog_tables(spark: SparkSession, database: str = "processed_db") -> Tables:
    """Tables stored by the daily load."""
    return Tables(lambda name: spark.table(f"{database}.{name}"))


def derived_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables derived in the query itself from the star-schema test tables."""

    def read(name: str) -> DataFrame:
        match name:
            case "web_traffic":
                return curate.web_traffic(raw.parse_log_lines(adapters.web_log_lines(spark, sf_dir)))
            case "sensor_readings":
                return curate.sensor_readings(adapters.raw_sensor_readings(spark, sf_dir))
            case "social_posts":
                return curate.social_posts(adapters.raw_social_posts(spark, sf_dir))
            case "device_metadata":
                return curate.device_metadata(adapters.raw_device_metadata(spark, sf_dir))
            case "sensor_daily_summary":
                return curate.sensor_daily_summary(read("sensor_readings"))
            case "trending_hashtags_daily":
                return curate.trending_hashtags_daily(read("social_posts"))
        raise KeyError(name)

    return Tables(read)
