"""Skewed keys: find them, and aggregate or join around them."""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def key_shares(df: DataFrame, keys: list[str], hot_share: float) -> DataFrame:
    """Rows per key, share of all rows, and whether the share reaches ``hot_share``."""
    counts = key_counts(df, keys)
    share = F.col("n").cast("double") / counts.agg(F.sum("n")).scalar().cast("double")
    return counts.withColumn("share", share).withColumn("is_hot", F.col("share") >= F.lit(hot_share))


#: Keys that a sketch can track at most, and the smallest share it can tell.
TRACKED = 1_000_000
LEAST_SHARE = 10 / TRACKED


def heavy_hitters(df: DataFrame, keys: list[str], hot_share: float) -> DataFrame:
    """``keys, n, share`` of the keys with at least ``hot_share`` of the rows, exactly; not all keys are shuffled.

    A frequent-items sketch of key hashes, merged from one small part per task, tracks ten times as many keys as can be
    hot, which keeps its error below half of the share: no hot key is missed. Its candidates, never more than a few
    times 1 / hot_share, are then counted anew; a key whose hash meets that of a hot one is found out by this. A null key is a key
    like any other. Both passes read the key columns only; the first runs at once.
    """
    if not LEAST_SHARE <= hot_share <= 1:
        raise ValueError(f"the share must be from {LEAST_SHARE} to 1")
    tracked = max(1000, math.ceil(10 / hot_share))
    name = F.xxhash64(*keys)
    sketch = F.expr(f"approx_top_k(h, {math.ceil(3 / hot_share)}, {tracked})")
    found = df.select(name.alias("h")).agg(sketch.alias("top"), F.count("*").alias("total")).first()
    total = found["total"]
    likely = [x["item"] for x in found["top"] or [] if x["count"] >= 0.4 * hot_share * total]
    counts = df.select(*keys).filter(name.isin(likely) if likely else F.lit(False)).groupBy(*keys).agg(F.count("*").alias("n"))
    shares = counts.withColumn("share", F.col("n").cast("double") / F.lit(float(max(1, total))))
    return shares.filter(F.col("share") >= F.lit(hot_share))


def hot_keys(df: DataFrame, keys: list[str], hot_share: float) -> DataFrame:
    """The keys with at least ``hot_share`` of the rows: never more than 1 / hot_share of them."""
    return heavy_hitters(df, keys, hot_share).select(*keys)


def _marked(df: DataFrame, keys: list[str], few: DataFrame, otherwise: dict[str, Column]) -> DataFrame:
    """``df`` with the columns named in ``otherwise``: from the row of ``few`` that has the same keys, nulls
    too, else as given. ``few`` is broadcast."""
    renamed = few.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], *otherwise)
    on = reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    found = df.join(F.broadcast(renamed), on, "left").drop(*[f"_hot_{k}" for k in keys])
    return found.withColumns({name: F.coalesce(name, value) for name, value in otherwise.items()})


def mark_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_hot``. ``hot`` is broadcast: its size is bounded by its own definition. A null key
    can be hot like any other."""
    return _marked(df, keys, hot.withColumn("_hot", F.lit(True)), {"_hot": F.lit(False)})


def _salts(df: DataFrame, salts: int | None) -> int:
    """As many salts as the cluster has shuffle partitions, unless given."""
    return salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _salt(spread_by: list[str], salts: int) -> Column:
    return F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(F.lit(0)).cast("int")


def salted_totals(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column],
    hot: DataFrame,
    spread_by: list[str],
    salts: int | None = None,
) -> DataFrame:
    """Sums and row count per key, in two stages: (key, salt), then key.

    The salt is a column of its own, so no key text can be mistaken for a salted one, and it
    comes from a hash of the row, so a task that runs again gives the same rows. Spark
    already combines sums before a shuffle; the first stage matters where that cannot help
    (many distinct keys per task, or a combine that spills).
    """
    salted = mark_hot(df, keys, hot).withColumn(SALT, _salt(spread_by, _salts(df, salts)))
    first = salted.groupBy(*keys, SALT).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    return first.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in sums]
    )


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    hot: DataFrame,
    spread_by: list[str],
    salts: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join in which each hot key is split over ``salts`` tasks.

    Rows of ``big`` take one salt; rows of ``small`` with a hot key are repeated once per
    salt, all others stay single. ``how`` may be ``inner`` or ``left``.
    """
    salts = _salts(big, salts)
    left = mark_hot(big, keys, hot).withColumn(SALT, _salt(spread_by, salts)).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salts_of = F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))
    right = mark_hot(small, keys, hot).withColumn(SALT, F.explode(salts_of)).drop("_hot")
    return left.join(right, [*keys, SALT], how).drop(SALT)


def hot_key_split_join(
    big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame, spread_by: list[str], salts: int | None = None
) -> DataFrame:
    """Inner join: each hot key split into as many parts as its share asks for, the rest left whole.

    ``hot`` comes from ``heavy_hitters``: a key with a third of the rows is dealt over a third of ``salts`` parts, and its
    rows of ``small`` are repeated for these only. Without a ``share`` a hot key takes all of them. Keys that are
    not hot are one part, so a single join, with one scan of each side, does both.
    """
    salts = _salts(big, salts)
    shared = "share" in hot.columns and "share" not in keys
    ways = F.ceil(F.col("share") * salts) if shared else F.lit(salts)
    sized = hot.select(*keys, ways.cast("int").alias("_ways"))
    left = _marked(big, keys, sized, {"_ways": F.lit(1)})
    left = left.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), F.col("_ways")).cast("int")).drop("_ways")
    right = _marked(small, keys, sized, {"_ways": F.lit(1)})
    right = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("_ways") - 1))).drop("_ways")
    return left.join(right, [*keys, SALT]).drop(SALT)
