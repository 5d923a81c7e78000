"""Cubes, rollups, shares of totals, ranking and growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _base(df: DataFrame, keys: list[str], sums: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """One row per finest combination, so that no raw row is repeated per level."""
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[F.count(c).alias(name) for name, c in counts.items()],
    )


def _merge(sums: dict[str, Column], counts: dict[str, Column]) -> list[Column]:
    return [F.sum(name).alias(name) for name in [*sums, *counts]]


def cube(df: DataFrame, keys: list[str], sums: dict[str, Column], counts: dict[str, Column] | None = None) -> DataFrame:
    """All combinations of subtotals, with ``level`` = grouping_id.

    ``cube`` on raw rows repeats every row 2^n times; here it repeats group totals.
    """
    counts = counts or {}
    grouped = _base(df, keys, sums, counts).cube(*keys)
    return grouped.agg(F.grouping_id().alias("level"), *_merge(sums, counts))


def rollup(df: DataFrame, keys: list[str], sums: dict[str, Column], counts: dict[str, Column] | None = None) -> DataFrame:
    counts = counts or {}
    grouped = _base(df, keys, sums, counts).rollup(*keys)
    return grouped.agg(F.grouping_id().alias("level"), *_merge(sums, counts))


def single_key_totals(df: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """One total per value of each key on its own, in a single pass."""
    base = _base(df, keys, sums, {})
    grouped = base.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys])
    return grouped.agg(F.grouping_id().alias("level"), *_merge(sums, {}))


def label_levels(df: DataFrame, labels: dict[int, str], name: str) -> DataFrame:
    """Replace ``level`` by a text; a real null in a key is told apart from a subtotal."""
    text = F.lit(None).cast("string")
    for level, label in labels.items():
        text = F.when(F.col("level") == level, label).otherwise(text)
    return df.withColumn(name, text).drop("level")


def top_per_group(df: DataFrame, keys: list[str], measure: str, k: int, name: str = "rank") -> DataFrame:
    """Rows of rank 1..k by ``measure``; ties share a rank.

    Spark keeps only the best k per key in each task before the shuffle.
    """
    ranked = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(measure).desc()))
    return df.withColumn(name, ranked).filter(F.col(name) <= k)


def growth(periods: DataFrame, period: str, measure: str) -> DataFrame:
    """Previous value and growth in percent. ``periods`` holds one row per period, so the
    unpartitioned window is as small as the number of periods."""
    before = F.lag(measure).over(Window.orderBy(period))
    change = F.try_divide(F.col(measure) - F.col("previous"), F.col("previous")) * 100
    return periods.withColumn("previous", before).withColumn("growth_rate", change)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``; other duplicates fall away before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")
