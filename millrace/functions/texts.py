"""Reading log lines, request lines, times and hashtags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as V


def typed(column: str | Column, kind: str) -> Column:
    """Type a text column; blank or malformed text becomes NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return c.try_cast(kind)


def _request_part(request: Column, index: int) -> Column:
    """A blank-separated part of a request line; empty where there is none, NULL for NULL."""
    parts = F.split(request, r"\s+")
    there = (F.get(parts, F.lit(0)) != "") & (F.size(parts) > F.lit(max(index, 1)))
    return F.when(there, F.get(parts, F.lit(index))).when(request.isNotNull(), F.lit(""))


def request_method(request: Column) -> Column:
    return _request_part(request, 0)


def request_target(request: Column) -> Column:
    return _request_part(request, 1)


def request_protocol(request: Column) -> Column:
    """The last part, if it names the protocol and its version."""
    last = F.substring_index(request, " ", -1)
    version = F.substring(last, 6, 1 << 20)
    named = F.startswith(last, F.lit("HTTP/")) & (version != "") & (F.translate(version, "0123456789.", "") == "")
    return F.when(named, last).when(request.isNotNull(), F.lit(""))


def target_part(target: Column, index: int) -> Column:
    """Path (0) or query text (1) of a URL; what follows a second '?' is dropped."""
    return F.get(F.split(target, r"\?"), F.lit(index))


def log_time(raw: Column) -> Column:
    """Access log time with its zone offset, as a UTC wall-clock timestamp.

    Counted from the epoch, so the session time zone plays no part.
    """
    seconds = F.unix_seconds(F.try_to_timestamp(raw, F.lit(V.LOG_TIME)))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return epoch + F.make_dt_interval(zero, zero, zero, seconds)


def wall_clock(raw: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a timestamp without time zone."""
    return typed(raw, "timestamp_ntz")


def day(ts: Column) -> Column:
    """``yyyy-MM-dd`` text, the partition key ``dt``."""
    return ts.cast("date").cast("string")


def hashtag_tokens(hashtags: Column) -> Column:
    """Blank-separated tokens; empty text gives one empty token."""
    return F.split(F.trim(hashtags), r"\s+")
