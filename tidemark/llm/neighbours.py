"""Approximate nearest neighbours by cross-polytope hashing.

A table turns each unit vector by a pseudo-random rotation (three rounds of sign flips and a fast
Hadamard transform) and files it under the signed axis it then lies nearest to. As the
number of vectors grows, a second, coarser hash is joined to the first, so that buckets keep their size,
and queries look into more of them, so that as much is found. A query looks into its own bucket and the next likeliest ones of each table; every vector found is
ranked by its exact cosine.

Equal vectors are searched once. Buckets that outgrow a block are dealt over several tasks, and a
query that finds too few is held against all vectors, block by block.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES, PROBES = 28, 4
#: Vectors that a bucket holds on average, and vectors or queries that a task compares at once.
BUCKET_ROWS, BLOCK_ROWS = 400, 4096
#: Share of random nearest pairs that probes must find once there is a second hash, and pairs tried.
LEAST_FOUND, PAIRS = 0.95, 500


def rotate(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Three rounds of random signs and the Hadamard transform; rows are padded to a power of two."""
    size = 1 << max(0, math.ceil(math.log2(max(1, x.shape[1]))))
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    for _ in range(3):
        y *= rng.choice((-1.0, 1.0), size)
        step = 1
        while step < size:
            y = y.reshape(len(x), -1, 2, step)
            y = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2)
            step *= 2
            y = y.reshape(len(x), size)
        y /= math.sqrt(size)
    return y


def coarse_axes(rows: int, dim: int) -> int:
    """Axes of the second hash that keeps buckets near ``BUCKET_ROWS``; 0 for none."""
    first = 2 << max(0, math.ceil(math.log2(max(1, dim))))
    wanted = rows / BUCKET_ROWS / first
    return 0 if wanted <= 1 else min(first // 2, 1 << max(0, math.ceil(math.log2(wanted / 2))))


def random_cosine(share: float, dim: int) -> float:
    """Cosine that this share of pairs of random unit vectors exceeds."""
    angle = (np.arange(100_000) + 0.5) * (math.pi / 100_000)
    mass = np.cumsum(np.sin(angle) ** max(0, dim - 2))
    return float(np.cos(angle[np.searchsorted(mass, share * mass[-1])])) if dim > 1 else 1.0


def enough_probes(rows: int, dim: int, k: int, probes: int, seed: int) -> int:
    """Probes with which the second hash finds what ``probes`` find without, or ``LEAST_FOUND``.

    Tried on pairs as far apart as the ``k``-th neighbour among ``rows`` random vectors: other vectors
    are closer to theirs.
    """
    axes = coarse_axes(rows, dim)
    if not axes:
        return probes
    rng = np.random.default_rng(seed)
    x, other = (_unit(rng.normal(size=(PAIRS, dim))) for _ in range(2))
    cosine = random_cosine(min(1.0, k / rows), dim)
    across = other - (other * x).sum(axis=1, keepdims=True) * x
    if dim > 1:
        across = _unit(across)
    y = cosine * x + math.sqrt(1 - cosine * cosine) * across

    def ranks(axes: int, n: int) -> np.ndarray:
        same = (buckets(x, axes, 1, seed) == buckets(y, axes, n, seed)).any(axis=1)
        return np.sort(np.where(same.any(axis=1), same.argmax(axis=1) + 1, n + 1))

    wanted = min(math.ceil(LEAST_FOUND * PAIRS), int((ranks(0, probes) <= probes).sum()))
    n, most = 8 * probes, (1 << max(0, math.ceil(math.log2(max(1, dim))))) * axes
    while wanted and (got := ranks(axes, min(n, most)))[wanted - 1] > n < most:
        n *= 4
    return max(probes, min(most, int(got[wanted - 1]))) if wanted else probes


def buckets(x: np.ndarray, axes: int, probes: int, seed: int) -> np.ndarray:
    """``rows x TABLES x probes`` bucket names: the likeliest buckets of each unit vector, best first."""
    out = np.empty((len(x), TABLES, probes), np.int64)
    for t in range(TABLES):
        rng = np.random.default_rng((seed, t))
        y = rotate(x, rng)
        names, away = _nearest(y, min(probes, y.shape[1]))
        if axes:
            other, further = _nearest(rotate(x, rng)[:, :axes], min(probes, axes))
            # A pair behind ``probes`` others in both hashes cannot be among the best.
            one, two = np.nonzero(np.outer(np.arange(names.shape[1]) + 1, np.arange(other.shape[1]) + 1) <= probes)
            names = names[:, one] * (2 * axes) + other[:, two]
            away = away[:, one] + further[:, two]
            best = np.argsort(away, axis=1, kind="stable")[:, :probes]
            names = np.take_along_axis(names, best, 1)
        if names.shape[1] < probes:
            names = np.pad(names, ((0, 0), (0, probes - names.shape[1])), mode="edge")
        out[:, t] = names * TABLES + t
    return out


def _nearest(y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` nearest signed axes of each row, and how much further each is than the nearest."""
    size = np.abs(y)
    axis = np.argsort(-size, axis=1, kind="stable")[:, :n]
    near = np.take_along_axis(size, axis, 1)
    return axis * 2 + (np.take_along_axis(y, axis, 1) < 0), (near[:, :1] - near) ** 2


def _valid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Usable vectors with a name that equal ones share."""
    for batch in batches:
        rows = []
        for i, vector in zip(batch["id"], batch["vector"]):
            if vector is None:
                continue
            x = np.asarray(vector, float) + 0.0
            if len(x) and np.isfinite(x).all() and x.any():
                rows.append((i, xxhash.xxh3_128_digest(x.tobytes()), x))
        yield pd.DataFrame(rows, columns=["id", "v", "x"])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _best(k: int):
    """The ``k`` nearest classes of each query in a group; ties go to the smaller id."""

    def compare(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            x, first = _unit(np.stack(index["x"].to_numpy())), index["first"].to_numpy()
            names = index["v"].to_numpy()
            for low in range(0, len(queries), 512):
                part = queries.iloc[low : low + 512]
                scores = _unit(np.stack(part["x"].to_numpy())) @ x.T
                for q, s in zip(part["v"], scores):
                    likely = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k]) if k < len(s) else np.arange(len(s))
                    for j in likely[np.lexsort((first[likely], -s[likely]))[:k]]:
                        out.append((q, names[j], s[j]))
        return pd.DataFrame(out, columns=["q", "v", "score"])

    return compare


def _searched(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``q, v, score`` of the nearest of each shared ``key``; hot keys are dealt over several groups."""
    many = lambda df, n: df.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(n)).filter(F.col(n) > 1)
    hot = stored(many(index, "parts").join(many(queries, "query_parts"), "key", "full").fillna(1), "hot-buckets")
    one = F.coalesce("parts", F.lit(1)), F.coalesce("query_parts", F.lit(1))
    mine = lambda c: F.pmod(F.xxhash64("v"), c).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    left = index.join(hot, "key", "left").select("key", "v", "x", "first", mine(one[0]).alias("a"), one[1].alias("n")).withColumn("b", every(F.col("n"))).drop("n")
    right = queries.join(hot, "key", "left").select("key", "v", "x", mine(one[1]).alias("b"), one[0].alias("n")).withColumn("a", every(F.col("n"))).drop("n")
    keys = ["key", "a", "b"]
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (left, right))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_best(k), "q binary, v binary, score double")


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, probes: int = PROBES, seed: int = 2
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` nearest rows found for each row of ``queries``, by cosine.

    A row is no neighbour of a row with its own id. Ties go to the smaller id. If there are fewer
    than ``k`` other rows, all are returned. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows with a null id; vectors are compared with those of
    equal length only. Repeated rows count once. Other columns are not looked at.
    """

    def ready(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return rows.filter("id is not null and vector is not null").mapInPandas(_valid, "id bigint, v binary, x array<double>")

    rows = stored(ready(vectors), "vectors")
    asked = stored(ready(queries), "query-vectors")
    # Of equal vectors, the k + 1 smallest ids can matter to a query, itself included.
    smallest = Window.partitionBy("v").orderBy("id")
    ids = rows.select("v", "id").distinct().withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= k + 1)
    ids = stored(ids.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vector-ids")
    once = lambda df: df.select("v", "x").dropDuplicates(["v"])
    classes = stored(once(rows).join(ids, "v").withColumn("first", F.col("ids")[0]), "vector-classes")
    wanted = stored(once(asked), "query-classes")
    sizes = {r.dim: r["count"] for r in classes.groupBy(F.size("x").alias("dim")).count().collect()}
    n = sum(sizes.values())
    tried = {dim: enough_probes(rows, dim, k, probes, seed) for dim, rows in sizes.items()}

    def keyed(df: DataFrame, counts: dict[int, int]) -> DataFrame:
        names = [c for c in df.columns if c in ("v", "x", "first")]

        def hash_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dim, part in batch.groupby(batch["x"].map(len)):
                    got = buckets(_unit(np.stack(part["x"].to_numpy())), coarse_axes(sizes.get(dim, 0), dim), counts.get(dim, 1), seed)
                    yield part.assign(keys=[sorted(set((g * 65_536 + dim % 65_536).ravel().tolist())) for g in got])

        kinds = dict(df.dtypes)
        made = df.select(*names).mapInPandas(hash_, ", ".join(f"{c} {kinds[c]}" for c in names) + ", keys array<bigint>")
        return made.select(*names, F.explode("keys").alias("key"))

    found = stored(_searched(keyed(classes, {}), keyed(wanted, tried), k + 1), "neighbours")
    reached = found.groupBy("q", "v").agg(F.max("score").alias("score")).join(ids, "v")
    enough = reached.groupBy("q").agg(F.sum(F.size("ids")).alias("m")).filter(F.col("m") >= k + 1).select(F.col("q").alias("v"))
    few = stored(wanted.join(enough, "v", "left_anti"), "few-neighbours")
    if not few.isEmpty():
        # Too few found: all vectors of their length, in blocks.
        blocks = max(1, -(-n // BLOCK_ROWS))
        dim = F.size("x").cast("bigint") * (1 << 32)
        index = classes.select("v", "x", "first", (dim + F.pmod(F.xxhash64("v"), F.lit(blocks))).alias("key"))
        every = few.select("v", "x", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: dim + b)).alias("key"))
        found = found.union(stored(_searched(index, every, k + 1), "neighbours"))
        reached = found.groupBy("q", "v").agg(F.max("score").alias("score")).join(ids, "v")
    each = reached.select("q", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    top = each.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    lists = stored(top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near")), "neighbour-lists")
    own = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")).distinct().join(lists, "q")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = own.select("query_id", F.posexplode(others).alias("at", "found"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias(id_col), F.col("found.score").alias("score"))
