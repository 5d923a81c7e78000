"""Groups of events over many micro-batches: their extent, and every event in order.

A batch stores parts that can be merged, never results: counts and extremes per (group, kind), and its events in
numbered chunks. What a group amounts to is known only when the parts are read together, so a
group with one event in each of two batches is a group of two. Parts carry the batch number, and a batch that runs again
overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import sequences


def batch_parts(batch: DataFrame, group: str, kind: str, time: str) -> DataFrame:
    """Per group and kind of a batch: how many events, the first and the last."""
    return batch.groupBy(group, kind).agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last"))


def merged_parts(parts: DataFrame, group: str, kind: str, least: int = 2) -> DataFrame:
    """Groups of at least ``least`` events, over all batches. A null kind is no kind."""
    kinds = parts.groupBy(group, kind).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    groups = kinds.groupBy(group).agg(
        F.sum("n").alias("events_in_group"), F.count(kind).alias("event_kinds"),
        times.seconds_between(F.min("first"), F.max("last")).alias("time_span_seconds"),
    )
    return groups.filter(F.col("events_in_group") >= least)


def batch_timeline(batch: DataFrame, group: str, order: list[str], fields: list[str], size: int = 1000) -> DataFrame:
    """The events of a batch per group, in order, in chunks of at most ``size``: no group is held whole."""
    entry = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *fields])])
    return sequences.chunked_lists(batch, [group], order, entry, size, "timeline")


def merged_timeline(chunks: DataFrame, group: str, order: list[str], entry: Column, size: int = 1000) -> DataFrame:
    """One timeline per group over all batches, numbered anew: group, ``chunk, entries, timeline``."""
    events = chunks.select(group, F.explode("timeline").alias("event")).select(group, "event.*")
    return sequences.chunked_lists(events, [group], order, entry, size, "timeline")
