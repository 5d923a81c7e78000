"""Ordered lists of the rows of a group.

One array per group has no bound. Here a list comes in chunks of a fixed length, numbered
from 0: an ordinary group has one chunk, a hot group has many, and every row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import slices


def chunked_lists(
    df: DataFrame, keys: list[str], order: list[str], entry: Column, size: int = 1000, name: str = "sequence"
) -> DataFrame:
    """Per key and chunk: the entries in order, at most ``size`` of them."""
    rows = df.withColumn("_entry", entry)
    numbered = slices.row_numbers(slices.ordered_slices(rows, keys, order), keys, order, "_row")
    chunk = F.floor((F.col("_row") - 1) / F.lit(size)).cast("int").alias("chunk")
    listed = F.array_sort(F.collect_list(F.struct("_row", "_entry")))
    grouped = numbered.groupBy(*keys, chunk).agg(listed.alias("_list"), F.count("*").alias("entries"))
    return grouped.withColumn(name, F.transform("_list", lambda x: x["_entry"])).drop("_list")
