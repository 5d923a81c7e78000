"""What the operators of this folder share: tables, stored steps, words, connected components."""

from __future__ import annotations

import gc
import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import using, written

# Send these functions along with the job: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows in one Arrow batch while a step is stored; keeps a batch of long texts small.
BATCH_ROWS = 256
#: Words that a worker remembers before it forgets all and starts anew.
REMEMBERED = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let the session send ``BATCH_ROWS`` rows at a time to Python: texts can be long, and a worker holds
    a batch several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write a step to the shared folder and read it back: computed once, lineage cut.

    ``release`` after a large step: Spark deletes the shuffle files of finished steps when the driver
    collects its garbage, which may otherwise be after the job.

    A join of two stored tables shuffles both sides itself, so that a hot key can be split
    at run time; an aggregate right under a join could not.
    """
    with using(df.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        out = written(df, label)
    if release:
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return out


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Bits for each key of a filter, and bits of the largest one: 8 MB.
KEY_BITS, MOST_BITS = 16, 1 << 26


def may_be_among(key: Column, keys: DataFrame) -> Column:
    """Whether ``key`` may be one of the (only) column of ``keys``; false is sure. A null key is not.

    A Bloom filter of bounded size: more keys only mean more that pass.
    """
    spark, name = keys.sparkSession, keys.columns[0]
    keys = keys.select(F.col(f"`{name}`").alias("k")).filter("k is not null")
    bits = min(MOST_BITS, 1 << max(10, int(keys.count() * KEY_BITS).bit_length()))
    places = lambda k: [F.pmod(F.xxhash64(F.lit(i), k), F.lit(bits)) for i in range(2)]
    each = keys.select(F.explode(F.array(*places(F.col("k")))).alias("p"))
    words = each.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("mask"))
    # At most MOST_BITS / 64 rows.
    found = words.toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(one: pd.Series, two: pd.Series) -> pd.Series:
        out = np.ones(len(one), bool)
        for p in (one.to_numpy(np.int64), two.to_numpy(np.int64)):
            out &= (shared.value[p >> 6] >> (p & 63) & 1).astype(bool)
        return pd.Series(out)

    return key.isNotNull() & passes(*places(key))


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between the six ASCII blanks, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` consecutive words; of all words if there are fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = (out + hashes[i : n - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(mixed(out))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``v, root`` for every end of ``links(a, b)``; root: one member that all of a component share.

    Every root with a smaller neighbour hooks to its smallest one, chains of hooks are
    shortened by pointer jumping, and the links are drawn again between roots. At least half
    of the linked roots go in each round.
    """
    both = lambda df: df.select("a", "b").union(df.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = stored(both(links.filter("a != b")), label)
    parents = edges.select(F.col("a").alias("v"), F.col("a").alias("root")).distinct()
    while not edges.isEmpty():
        hooks = stored(edges.groupBy("a").agg(F.min("b").alias("to")).filter("to < a"), label)
        while True:
            ahead = hooks.select(F.col("a").alias("to"), F.col("to").alias("further"))
            jumped = stored(
                hooks.join(ahead, "to", "left").select("a", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")),
                label,
            )
            moved = not jumped.filter("moved").isEmpty()
            hooks = jumped.select("a", "to")
            if not moved:
                break
        parents = stored(
            parents.join(hooks.withColumnRenamed("a", "root"), "root", "left").select("v", F.coalesce("to", "root").alias("root")),
            label,
        )
        edges = edges.join(hooks, "a", "left").select(F.coalesce("to", "a").alias("a"), "b")
        edges = edges.join(hooks.select(F.col("a").alias("b"), "to"), "b", "left").select("a", F.coalesce("to", "b").alias("b"))
        edges = stored(edges.filter("a != b").distinct(), label)
    return parents
