"""Ordered window functions that stay balanced when one key holds much of the table.

``Window.partitionBy(key)`` sends a whole key to one task. Here the rows are range
partitioned on (key, order) instead, so a hot key spans many slices. Each function then
works inside the (key, slice) parts, after a row that holds what earlier slices of the same
key carry over.

The order columns must identify a row within its key.

Keys with fewer rows than one task's share need none of this: ``keyed`` slices hot keys only and
gives all others an ordinary window with its one exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import LEAST_SHARE, hot_keys, mark_hot
from tidemark.session import written

SLICE = "_slice"

# Column names, or sort expressions such as ``F.desc("price")``.
Order = list[str | Column]


def ordered_slices(
    df: DataFrame, keys: list[str], order: Order, slices: int | None = None
) -> DataFrame:
    """Range partition by (keys, order), number the parts and write them.

    Range bounds come from a sample, so the numbers are fixed by writing the rows once.
    """
    by = [*[F.col(c) for c in keys], *[F.col(c) if isinstance(c, str) else c for c in order]]
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return written(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def _earlier(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _with_heads(sliced: DataFrame, carry: DataFrame) -> DataFrame:
    """Put what is carried over in front of each (key, slice) as a row of its own.

    Only keys that span slices have such rows, so there are fewer than slices. Grouping
    instead of joining also keeps rows whose key is null.
    """
    heads = carry.filter("_carry IS NOT NULL").withColumn("_is_row", F.lit(False))
    return sliced.withColumn("_is_row", F.lit(True)).unionByName(heads, allowMissingColumns=True)


def _inside(keys: list[str], order: Order) -> Window:
    return Window.partitionBy(*keys, SLICE).orderBy("_is_row", *order)


def running_sum(sliced: DataFrame, keys: list[str], order: Order, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row."""
    parts = sliced.groupBy(*keys, SLICE).agg(F.sum(value).alias("_part"))
    carry = parts.select(*keys, SLICE, F.sum("_part").over(_earlier(keys)).alias("_carry"))
    added = F.when(F.col("_is_row"), value).otherwise(F.col("_carry"))
    upto = F.sum(added).over(_inside(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return _with_heads(sliced, carry).withColumn(name, upto).filter("_is_row").drop("_carry", "_is_row")


def row_numbers(sliced: DataFrame, keys: list[str], order: Order, name: str) -> DataFrame:
    """Position of the row within its key, from 1."""
    return running_sum(sliced, keys, order, F.lit(1), name)


def previous(sliced: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``value`` of the row before this one within its key, in ascending order of the named
    columns; null for the first row."""
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last")
    parts = sliced.groupBy(*keys, SLICE).agg(last)
    # Every (key, slice) present has rows, so the carry is the last row one slice earlier.
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy(SLICE))
    carry = parts.select(*keys, SLICE, before.alias("_carry"))
    seen = F.when(F.col("_is_row"), F.col(value)).otherwise(F.col("_carry")["v"])
    found = F.lag(seen).over(_inside(keys, order))
    return _with_heads(sliced, carry).withColumn(name, found).filter("_is_row").drop("_carry", "_is_row")


def keyed(
    df: DataFrame,
    keys: list[str],
    plain: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    hot_share: float | None = None,
) -> DataFrame:
    """``plain`` of the rows of ordinary keys together with ``sliced`` of the rows of hot ones.

    A key is hot from ``hot_share`` of the rows on: what one shuffle partition holds, unless given. Both
    functions return the same columns.
    """
    share = hot_share or max(LEAST_SHARE, 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = written(hot_keys(df, keys, share), "hot-keys")
    if hot.isEmpty():
        return plain(df)
    marked = mark_hot(df, keys, hot)
    return plain(marked.filter("not _hot").drop("_hot")).unionByName(sliced(marked.filter("_hot").drop("_hot")))


def keyed_sum(df: DataFrame, keys: list[str], order: Order, value: Column, name: str, hot_share: float | None = None) -> DataFrame:
    """``running_sum`` where only hot keys are sliced."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return keyed(
        df, keys,
        lambda rows: rows.withColumn(name, F.sum(value).over(upto)),
        lambda rows: running_sum(ordered_slices(rows, keys, order), keys, order, value, name).drop(SLICE),
        hot_share,
    )


def keyed_numbers(df: DataFrame, keys: list[str], order: Order, name: str, hot_share: float | None = None) -> DataFrame:
    """``row_numbers`` where only hot keys are sliced."""
    return keyed_sum(df, keys, order, F.lit(1), name, hot_share)


def keyed_previous(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, hot_share: float | None = None) -> DataFrame:
    """``previous`` where only hot keys are sliced."""
    return keyed(
        df, keys,
        lambda rows: rows.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))),
        lambda rows: previous(ordered_slices(rows, keys, order), keys, order, value, name).drop(SLICE),
        hot_share,
    )


def keyed_ranks(df: DataFrame, keys: list[str], value: str, name: str, hot_share: float | None = None) -> DataFrame:
    """``ranks`` where only the values of hot keys are counted, sliced and joined back."""
    falling = Window.partitionBy(*keys).orderBy(F.desc(value))
    return keyed(
        df, keys,
        lambda rows: rows.withColumn(name, F.rank().over(falling).cast("bigint")),
        lambda rows: ranks(rows, keys, value, name),
        hot_share,
    )


def ranks(df: DataFrame, keys: list[str], value: str, name: str, slices: int | None = None) -> DataFrame:
    """``rank()`` by ``value`` descending: 1 plus the rows of the key with a greater value.

    Rows are first counted per distinct value, so ties of any size meet as one row.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    falling = [F.desc(value)]
    sliced = ordered_slices(counts, keys, falling, slices)
    upto = running_sum(sliced, keys, falling, F.col("_n"), "_upto")
    ranked = upto.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*keys, value]], (F.col("_upto") - F.col("_n") + 1).alias(name)
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*keys, value]]
    return df.join(ranked, same).drop(*[f"_of_{c}" for c in [*keys, value]])
