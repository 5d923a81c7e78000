"""Sessions in bounded tables.

``session_window`` sorts all rows of a key in one task. Here rows are first combined into
cells no wider than the gap: rows of one cell always share a session. What reaches the
window is then at most one row per (key, cell, type), however many rows a hot key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import micro_bucket, seconds_interval


def session_parts(
    df: DataFrame, key: str, time: str, gap_seconds: int, by: list[str], sums: dict[str, Column] | None = None
) -> DataFrame:
    """Per key, session and ``by``: row count, sums, first and last time.

    A row starts a session when it comes more than the gap after the one before it.
    Rows without a time belong to no session. ``session_start`` names the session; its window ends at the last time plus the gap.
    """
    sums = sums or {}
    cell = micro_bucket(F.col(time), gap_seconds).alias("_cell")
    cells = df.filter(F.col(time).isNotNull()).groupBy(key, cell, *by).agg(
        F.count("*").alias("n"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    of_cell = Window.partitionBy(key).orderBy("_cell").rangeBetween(0, 0)
    before = Window.partitionBy(key).orderBy("_cell").rangeBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(key).orderBy("_cell").rangeBetween(Window.unboundedPreceding, 0)
    bounded = cells.withColumn("_cell_start", F.min("first_time").over(of_cell))
    bounded = bounded.withColumn("_seen", F.max("last_time").over(before))
    opens = F.col("_seen").isNull() | (F.col("_cell_start") > F.col("_seen") + seconds_interval(gap_seconds))
    started = bounded.withColumn("_opens", F.when(opens, F.col("_cell_start")))
    named = started.withColumn("session_start", F.max("_opens").over(upto))
    return named.groupBy(key, "session_start", *by).agg(
        F.sum("n").alias("n"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        *[F.sum(name).alias(name) for name in sums],
    )
