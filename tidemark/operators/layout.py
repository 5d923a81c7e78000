"""How rows lie in partitions: reports, and layouts for later reads."""

from __future__ import annotations

from contextlib import redirect_stdout
from io import StringIO
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def partition_sizes(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows per partition, empty partitions included.

    ``n`` is the least number of partitions to report (asking Spark for it plans the frame a second
    time); partitions beyond it are reported too.
    """
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
    every = df.sparkSession.range(n or df.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("partition"))
    return every.join(counts, "partition", "full").na.fill(0, ["rows"])


def partition_report(df: DataFrame, n: int | None = None) -> DataFrame:
    """One row: number of partitions, rows, average, extremes, skew (max / average), verdict."""
    sizes = partition_sizes(df, n).agg(
        F.count("*").alias("num_partitions"),
        F.sum("rows").alias("total_records"),
        F.avg("rows").alias("avg_partition_size"),
        F.max("rows").alias("max_partition_size"),
        F.min("rows").alias("min_partition_size"),
    )
    skew = F.coalesce(F.try_divide(F.col("max_partition_size"), F.col("avg_partition_size")), F.lit(0.0))
    verdict = F.when(F.col("skew_ratio") > 3, "high").when(F.col("skew_ratio") > 1.5, "moderate")
    return sizes.withColumn("skew_ratio", skew).withColumn("assessment", verdict.otherwise("balanced"))


def partition_heads(df: DataFrame, rows: int = 3) -> DataFrame:
    """The first rows of every partition, found where they lie: no shuffle, no sort."""
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    numbered = numbered.withColumn("partition", F.shiftright("_at", _ROW_BITS).cast("int"))
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.withColumn("row_in_partition", row).filter(row < rows).drop("_at")


def round_robin(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def by_hash(df: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def by_range(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Neighbouring values together; bounds follow the data, so parts are of like size."""
    return df.repartitionByRange(n, *keys)


def write_ranges(df: DataFrame, keys: list[str], n: int, path: str) -> None:
    """``n`` files or so by range of ``keys``, each sorted inside: the minima and maxima in the footers of files and row groups then
    tell a reader with a filter on ``keys`` which of them to skip. A very common value fills a range of its own."""
    by_range(df, keys, n).sortWithinPartitions(*keys).write.parquet(path)


def fewer(df: DataFrame, n: int) -> DataFrame:
    """Join partitions without a shuffle."""
    return df.coalesce(n)


def spread(df: DataFrame, key: str, row_id: list[str], n: int, ways: int | None = None) -> DataFrame:
    """Hash by (key, part of the row): a key meets in at most ``ways`` lots (four per partition, unless
    given), so even a key with a third of the rows does not fill a single task."""
    part = F.pmod(F.xxhash64(*row_id), F.lit(ways or 4 * n))
    return df.repartition(n, F.col(key), part)


def volume_classes(df: DataFrame, key: str, high: float, medium: float) -> DataFrame:
    """Class of each value of ``key`` by its share of all rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("group_rows"))
    share = F.col("group_rows") / counts.agg(F.sum("group_rows")).scalar().cast("double")
    label = F.when(share >= high, "high").when(share >= medium, "medium").otherwise("low")
    return counts.withColumn("volume", label)


def volume_aware(
    df: DataFrame, key: str, spread_by: Column, high: float, medium: float, n: int, medium_ways: int | None = None
) -> DataFrame:
    """Layout by volume in one shuffle: values of a high class are spread by ``spread_by``, of
    a medium class over ``medium_ways`` parts (the largest share it can have of the ``n`` parts,
    unless given), of a low class kept together."""
    medium_ways = medium_ways or max(1, ceil(high * n))
    classes = volume_classes(df, key, high, medium).withColumnRenamed(key, "_class_key")
    classed = df.join(classes, F.col(key).eqNullSafe(F.col("_class_key"))).drop("_class_key")
    hashed = F.xxhash64(spread_by)
    lane = F.when(F.col("volume") == "high", hashed)
    lane = lane.when(F.col("volume") == "medium", F.pmod(hashed, F.lit(medium_ways))).otherwise(F.lit(0))
    return classed.repartition(n, F.col(key), lane)


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``explain`` prints, as text."""
    out = StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def exchange_count(df: DataFrame) -> int:
    """Hash, range, round-robin and single-partition exchanges in the plan (broadcasts not counted)."""
    plan = explain_text(df, "simple")
    return plan.count("Exchange ") - plan.count("BroadcastExchange ")
