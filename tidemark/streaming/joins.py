"""Joins between streams, and between a stream and a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import plain
from tidemark.operators.intervals import enclosing_window
from tidemark.operators.joins import dimension_join

# Weight of a page view by the priority of the page; all others count once.
PRIORITY_WEIGHT = {"Critical": 3, "High": 2}


def priority_score(priority: Column, views: Column) -> Column:
    weight = F.lit(1)
    for name, value in PRIORITY_WEIGHT.items():
        weight = F.when(priority == name, value).otherwise(weight)
    return views * weight


def enrich(windows: DataFrame, reference: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """Left join of window totals to a reference table, with defaults for unknown keys."""
    joined = dimension_join(windows, reference, [key], "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def join_enclosing(fine: DataFrame, coarse: DataFrame, size: str, how: str = "left_outer") -> DataFrame:
    """Join windows to the larger windows that hold them.

    Both sides are aggregates with a ``window`` column. A range condition has no equality to
    hash on; the enclosing window of the fine one is such an equality, and keeps the
    watermark so that outer rows come out when the larger window closes. The fine window
    stays as plain ``fine_start`` and ``fine_end``: a stream has one event-time column.
    """
    left = fine.withColumns({
        "fine_start": plain("window.start"),
        "fine_end": plain("window.end"),
        "window": enclosing_window(F.col("window"), size),
    })
    return left.join(coarse, ["window"], how)


def align(first: DataFrame, others: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left join of window aggregates on (key, window): all windows are of one size."""
    for other in others:
        first = first.join(other, [*keys, "window"], "left_outer")
    return first
