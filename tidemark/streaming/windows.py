"""Windowed aggregates over event time.

All functions take a stream with its watermark set (a bounded table works too) and return
one row per window and key. In append mode a window is final once the watermark passes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times


def windowed(
    df: DataFrame, time: str, size: str, keys: list[str], measures: list[Column], slide: str | None = None
) -> DataFrame:
    """Tumbling windows, or sliding ones when ``slide`` is given."""
    span = F.window(time, size, slide) if slide else F.window(time, size)
    return df.groupBy(span, *keys).agg(*measures)


def windowed_distinct(
    df: DataFrame,
    time: str,
    size: str,
    keys: list[str],
    distinct: dict[str, str],
    sums: dict[str, Column],
    extremes: dict[str, Column] | None = None,
    slide: str | None = None,
    buckets: int = 32,
) -> DataFrame:
    """Window totals together with exact distinct counts.

    A stream rejects ``count(distinct)``. Each row is repeated once per counted column, a
    first stage groups by (window, keys, column, hash bucket of the value) and keeps the bucket's distinct
    values, and a second one adds up how many they are. A window has as many rows of state as there are buckets, not
    as there are values, and its values are spread over all tasks.
    ``distinct`` maps output names to columns; ``extremes`` gives ``min_``/``max_`` columns.
    """
    extremes = extremes or {}
    names = list(distinct)
    marks = []
    for name, column in distinct.items():
        value = F.col(column).cast("string")
        bucket = F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")
        marks.append(F.struct(F.lit(names.index(name)).alias("what"), bucket.alias("bucket"), value.alias("id")))
    marked = df.withColumn("_mark", F.explode(F.array(*marks)))
    span = F.window(time, size, slide) if slide else F.window(time, size)
    first = marked.groupBy(span, *keys, F.col("_mark.what").alias("_what"), F.col("_mark.bucket").alias("_bucket")).agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[F.min(c).alias(f"min_{name}") for name, c in extremes.items()],
        *[F.max(c).alias(f"max_{name}") for name, c in extremes.items()],
        F.collect_set("_mark.id").alias("_ids"),
    )
    # Totals are complete in the rows of any one counted column.
    once = F.col("_what") == 0
    return first.groupBy("window", *keys).agg(
        F.sum(F.when(once, F.col("n"))).alias("n"),
        *[F.sum(F.when(once, F.col(name))).alias(name) for name in sums],
        *[F.min(f"min_{name}").alias(f"min_{name}") for name in extremes],
        *[F.max(f"max_{name}").alias(f"max_{name}") for name in extremes],
        *[F.sum(F.when(F.col("_what") == i, F.size("_ids")).otherwise(0)).alias(name) for i, name in enumerate(names)],
    )


def coarser(windows: DataFrame, size: str, keys: list[str], measures: list[Column]) -> DataFrame:
    """Aggregate windows into larger ones.

    The window column itself is passed on, which keeps the watermark; its ``start`` alone
    would lose it.
    """
    return windows.groupBy(F.window("window", size), *keys).agg(*measures)


def type_counts(
    df: DataFrame,
    time: str,
    size: str,
    keys: list[str],
    kind: str,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
) -> DataFrame:
    """Per window and key: rows, sums, maxima, and a ``type:count`` list.

    The list stands for a list of every single type: it keeps how often each occurred, but
    is only as long as there are types, so a busy window stays small.
    """
    sums, maxima = sums or {}, maxima or {}
    first = df.groupBy(F.window(time, size), *keys, kind).agg(
        F.count("*").alias("n"),
        F.min(time).alias("first_time"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[F.max(c).alias(name) for name, c in maxima.items()],
    )
    # A null kind is named, and the list is sorted by kind.
    listed = F.struct(F.coalesce(F.col(kind), F.lit("null")).alias("kind"), F.col("n").cast("string").alias("n"))
    return first.groupBy("window", *keys).agg(
        F.sum("n").alias("n"),
        F.min("first_time").alias("first_time"),
        *[F.sum(name).alias(name) for name in sums],
        *[F.max(name).alias(name) for name in maxima],
        F.array_join(F.transform(F.array_sort(F.collect_list(listed)), lambda x: F.concat_ws(":", x["kind"], x["n"])), ",").alias("types"),
    )


def event_sequences(
    df: DataFrame, time: str, size: str, keys: list[str], fields: list[str], slide: str | None = None, slice_seconds: int = 60, chunk: int = 1000
) -> DataFrame:
    """The events of each window and key in order, as the watermark closes the window.

    State holds the events of a window by slices of time, so that those of a busy key are spread over tasks and
    no row of state is the whole window; a closed slice comes out in chunks of at most ``chunk`` events. In order of
    (``slice_start``, ``chunk``) the lists give the sequence, sorted by time and then ``fields``.
    """
    span = F.window(time, size, slide) if slide else F.window(time, size)
    event = F.struct(F.col(time).alias("time"), *[F.col(c) for c in fields])
    # A frame may have one kind of window: slices come from plain arithmetic.
    start = F.timestamp_micros(times.micro_bucket(F.col(time), slice_seconds)).alias("slice_start")
    listed = df.groupBy(span, *keys, start).agg(F.array_sort(F.collect_list(event)).alias("events"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("events") - 1) / chunk).cast("int")), lambda i: F.slice("events", i * chunk + 1, F.lit(chunk))
    )
    return listed.select("window", *keys, "slice_start", F.posexplode(pieces).alias("chunk", "sequence"))
