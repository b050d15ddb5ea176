"""Shared small helpers of the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder
from ..sources.sinks import staging_folder

_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write a result to the shared folder and go on from the files.

    Cuts the lineage: a lost executor costs a reread, not a second run of what
    led here. Inside ``scratch`` the files go when the block ends; else the caller
    removes ``llm-*`` in the shared folder when no result that reads them is needed.
    """
    spark = df.sparkSession
    folder = f"{_SCRATCH.get() or shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what operators write inside; results must be stored by then."""
    with staging_folder(spark, "llm") as folder:
        before = _SCRATCH.set(folder)
        try:
            yield
        finally:
            _SCRATCH.reset(before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partitions_for(items: int, each: int, least: int = 1) -> int:
    return max(least, -(-items // each))


def only(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns and no other, so that extra ones cannot clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])
