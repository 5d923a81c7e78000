"""Joins of rows whose times do not line up.

A range condition alone would compare every pair. Each join here first meets on a key and a
time bucket, an equality that Spark can hash and spread, and then applies the exact
condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import micro_bucket, micros, seconds_interval


def tolerance_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_time: str,
    right_time: str,
    tolerance_seconds: int,
    how: str = "left",
) -> DataFrame:
    """Right rows in [left_time, left_time + tolerance], same key. Batch or streaming.

    With buckets as wide as the tolerance a partner lies in the same bucket or the next, so
    each right row is offered to two buckets and meets a left row at most once. A hot key is
    thereby spread over its time buckets. Column names must differ between the sides.
    """
    lefts = left.withColumn("_left_bucket", micro_bucket(F.col(left_time), tolerance_seconds))
    own = micro_bucket(F.col(right_time), tolerance_seconds)
    rights = right.withColumn("_right_bucket", F.explode(F.array(own, own - micros(tolerance_seconds))))
    limit = seconds_interval(tolerance_seconds)
    on = (
        (F.col("_left_bucket") == F.col("_right_bucket"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= F.col(left_time) + limit)
    )
    for a, b in keys:
        on = on & (F.col(a) == F.col(b))
    return lefts.join(rights, on, how).drop("_left_bucket", "_right_bucket")


def _cover(first: Column, last: Column, levels: int) -> Column:
    """The fewest dyadic blocks ``(level, block)`` that make up the cells from ``first`` to ``last``.

    Block ``b`` of level ``k`` holds the cells from ``b * 2 ** k``. Going up a level, a side that is not aligned gives
    its block away, so there are at most two blocks per level, however long the span.
    """

    def of(k: Column) -> Column:
        low, high = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1).cast("bigint"), k) - 1, k), F.call_function("shiftright", last + 1, k)
        block = lambda when, b: F.when((low < high) & when, F.struct(k.alias("level"), b.alias("block")))
        return F.array(block(low % 2 != 0, low), block(high % 2 != 0, high - 1))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), of))
    return F.filter(every, lambda x: x.isNotNull())


def _above(cell: Column, levels: int) -> Column:
    """The block of each level that holds a cell."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", cell, k).alias("block")))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width_seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Pairs of the same key whose closed spans overlap. Batch; ``inner`` or ``left``.

    Spans overlap where one starts within the other. Time is cut into cells of ``width_seconds``; a span is offered to the
    dyadic blocks that make it up, a start to the block of each level that holds its cell. They share exactly one block: first the
    right starts within the left span, then the left starts in a later cell of the right one. So a span costs
    rows by the logarithm of its length, years or an end far in the future included. The number of levels follows the
    longest span, which is found first.

    For ``left`` the left rows must be unique by key and span: a row without a match, or without a span, or with an end before
    its start, is kept once. Null keys match nothing.
    """
    (ls, le), (rs, re) = left_span, right_span
    # The bucket is a whole multiple of the width, so the division is exact.
    cell = lambda c: F.expr(f"(unix_micros(`{c}`) - pmod(unix_micros(`{c}`), {micros(width_seconds)}L)) div {micros(width_seconds)}L")
    span = lambda df, start, end: df.agg(F.max(cell(end) - cell(start))).first()[0] or 0
    levels = max(1, int(max(span(left, ls, le), span(right, rs, re)) + 1).bit_length())

    def offered(df: DataFrame, start: str, end: str, is_left: bool) -> DataFrame:
        within = _cover(cell(start) + F.lit(0 if is_left else 1), cell(end), levels)
        roles = ("left", "right") if is_left else ("right", "left")
        named = lambda blocks, role: F.transform(blocks, lambda x: F.struct(F.lit(role).alias("within"), x["level"].alias("level"), x["block"].alias("block")))
        blocks = F.concat(named(within, roles[0]), named(_above(cell(start), levels), roles[1]))
        return df.select("*", F.posexplode_outer(F.when(F.col(end) >= F.col(start), blocks)).alias("_at", "_block"))

    rights = offered(right, rs, re, False).withColumn("_matched", F.lit(True)).drop("_at")
    for key in [*keys, "_block"]:
        rights = rights.withColumnRenamed(key, f"_right{key}")
    lefts = offered(left, ls, le, True)
    on = (F.col(ls) <= F.col(re)) & (F.col(le) >= F.col(rs))
    for part in ("within", "level", "block"):
        on = on & (F.col(f"_block.{part}") == F.col(f"_right_block.{part}"))
    for key in keys:
        on = on & (F.col(key) == F.col(f"_right{key}"))
    pairs = lefts.join(rights, on, how).drop(*[f"_right{key}" for key in [*keys, "_block"]])
    if how == "left":
        anywhere = F.max("_matched").over(Window.partitionBy(*keys, ls, le))
        pairs = pairs.withColumn("_anywhere", anywhere)
        once = F.coalesce(F.col("_at") == 0, F.lit(True))
        pairs = pairs.filter(F.col("_matched") | (F.col("_anywhere").isNull() & once)).drop("_anywhere")
    return pairs.drop("_block", "_at", "_matched")


def enclosing_window(window: Column, size: str) -> Column:
    """The window of ``size`` that holds a smaller window (sizes must divide)."""
    return F.window(F.window_time(window), size)
