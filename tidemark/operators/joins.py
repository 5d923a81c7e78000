"""Equi joins with a stated strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dimension_join(facts: DataFrame, dimension: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Facts with their dimension. Spark broadcasts the dimension when its bytes, as known from the
    files or measured at run time, are under its threshold, and shuffles both sides if not."""
    return facts.join(dimension, on, how)


def merge_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Shuffle both sides and merge; the adaptive planner splits skewed partitions."""
    return left.join(right.hint("merge"), on, how)


def copartitioned_join(many: DataFrame, one: DataFrame, key: str, n: int) -> DataFrame:
    """Both sides hashed to ``n`` partitions on ``key``, so the join adds no exchange.

    ``many`` should hold one row per key by now (aggregate it first): a fixed number of
    partitions is not split by the adaptive planner.
    """
    return many.repartition(n, key).join(one.repartition(n, key), key)


def without_match(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` that have no partner; the right keys are made distinct first."""
    return left.join(right.select(*on).distinct(), on, "left_anti")
