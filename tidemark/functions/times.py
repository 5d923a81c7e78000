"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(c: Column | str) -> Column:
    """To TIMESTAMP, the only type a watermark accepts."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def plain(c: Column | str) -> Column:
    """To TIMESTAMP_NTZ, for output that does not depend on the session time zone."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def epoch_bucket(seconds: Column, width: int) -> Column:
    """Start of the ``width``-second bucket that holds an epoch second."""
    return seconds - F.pmod(seconds, F.lit(width))


def micro_bucket(t: Column, width_seconds: int) -> Column:
    """The same for an instant, in microseconds: whole numbers only, so bounds are exact."""
    us = F.unix_micros(t)
    return us - F.pmod(us, F.lit(micros(width_seconds)))


def offset_in(seconds: Column, width: int) -> Column:
    """Seconds since the start of the enclosing ``width``-second period."""
    return F.pmod(seconds, F.lit(width)).cast("long")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60)


def seconds_interval(seconds: int) -> Column:
    """A constant interval; written as a literal, which stream joins need to see."""
    return F.expr(f"INTERVAL {seconds} SECONDS")


def micros(seconds: int) -> int:
    return seconds * 1_000_000


def arrival_status(event_time: Column, seen_at: Column, limit_seconds: int) -> Column:
    """``LATE`` when a row was seen more than the limit after it happened."""
    return F.when(seen_at - event_time > seconds_interval(limit_seconds), "LATE").otherwise("ON_TIME")


def processing_delay(event_time: Column) -> Column:
    """Seconds between the event and now; a monitoring column, never part of a result."""
    return F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(event_time)
