"""Hard negatives: rows of another label that score just below a row of the same label.

Each vector is turned by a pseudo-random rotation and kept as the signs of its components, with the
alignment of vector and signs; what the signs leave over is turned and kept in the same way, a few times. An anchor is
turned likewise and its components rounded to a few bits, so that its product with a row's signs is a few bit counts.
Rounding is bounded by its sum, and what remains of the row by the Cauchy-Schwarz inequality, so
each pair gets an interval that surely holds its score. Pairs whose interval cannot matter are let go, the
others are scored exactly as integers: the result is that of scoring all pairs.

Anchors are a stated set of queries: each meets all rows, block by block.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.neighbours import rotate

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One-bit codes of each row, and bits of each component of an anchor.
STAGES, PLANES = 4, 6
#: Rows and anchors that a task compares, and anchors it compares at once.
BLOCK_ROWS, BLOCK_ANCHORS, AT_ONCE = 8192, 1024, 64
_LONG = 2**63 - 1


def _turned(x: np.ndarray, stage: int) -> np.ndarray:
    return rotate(x, np.random.default_rng((7, stage)))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rows x STAGES x words`` sign bits, ``rows x STAGES`` alignments, and the length of what remains."""
    bits, alignments = [], []
    for stage in range(STAGES):
        x = _turned(x, stage)
        positive = x >= 0
        alignment = np.abs(x).mean(axis=1)
        x = x - np.where(positive, alignment[:, None], -alignment[:, None])
        packed = np.packbits(positive, axis=1)
        packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
        bits.append(packed.view(np.uint64))
        alignments.append(alignment)
    return np.stack(bits, axis=1), np.stack(alignments, axis=1), np.sqrt((x * x).sum(axis=1))


def intervals(q: np.ndarray, bits: np.ndarray, alignments: np.ndarray, rest: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of ``q`` with encoded rows of the given lengths."""
    with np.errstate(all="ignore"):
        low, high = _intervals(q, bits, alignments, rest, lengths)
    # Numbers too large to be squared leave no bounds.
    return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)


def _intervals(q: np.ndarray, bits: np.ndarray, alignments: np.ndarray, rest: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((q * q).sum(axis=1))
    middle, slack = np.zeros((len(q), len(bits))), np.zeros((len(q), len(bits)))
    for stage in range(STAGES):
        q = _turned(q, stage)
        size = q.shape[1]
        low = q.min(axis=1, keepdims=True)
        step = (q.max(axis=1, keepdims=True) - low) / (2**PLANES - 1)
        step[step == 0] = 1.0
        steps = np.rint((q - low) / step).astype(np.int64)
        lost = np.abs(q - low - step * steps).sum(axis=1, keepdims=True)
        planes = np.packbits((steps[:, None] >> np.arange(PLANES)[:, None] & 1).astype(bool), axis=2)
        planes = np.ascontiguousarray(np.pad(planes, ((0, 0), (0, 0), (0, -planes.shape[2] % 8)))).view(np.uint64)
        inside, ones = np.zeros((len(q), len(bits)), np.int32), np.zeros(len(bits), np.int64)
        for word in range(bits.shape[2]):
            mine = bits[:, stage, word]
            ones += np.bitwise_count(mine)
            for plane in range(PLANES):
                inside += np.bitwise_count(mine & planes[:, plane, word, None]).astype(np.int32) << plane
        product = low * (2 * ones - size) + step * (2 * inside - steps.sum(axis=1, keepdims=True))
        middle += alignments[:, stage] * product
        slack += alignments[:, stage] * lost
    # What remains of a row is square to its last signs, so only that part of the anchor counts.
    across = np.sqrt(np.maximum(0, (norm * norm)[:, None] - np.maximum(0, np.abs(product) - lost) ** 2 / size))
    slack += across * rest + 1e-9 * (norm[:, None] * lengths + 1)
    return middle - slack, middle + slack


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of paired rows, exact; at most the largest long, at least that below zero."""
    if not len(a):
        return np.empty(0, np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2.0**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    if most < 2.0**62:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    exact = [sum(int(x) * int(y) for x, y in zip(r, s)) for r, s in zip(a, b)]
    return np.array([max(-_LONG, min(_LONG, x)) for x in exact], np.int64)


def _numbers(column: pd.Series, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


class _Block:
    """Rows of one group, ready to be compared."""

    def __init__(self, rows: pd.DataFrame):
        self.ids, self.labels, self.x = rows["id"].to_numpy(), rows["label"].to_numpy(), _numbers(rows["x"])
        self.bits = _numbers(rows["bits"], np.uint64).reshape(len(rows), STAGES, -1)
        self.alignments, self.rest = _numbers(rows["alignments"]), rows["rest"].to_numpy()
        with np.errstate(over="ignore"):
            self.lengths = np.sqrt((self.x * self.x).sum(axis=1))

    def bounds(self, anchors: pd.DataFrame) -> Iterator[tuple]:
        """Each anchor with its vector and bounds."""
        for start in range(0, len(anchors), AT_ONCE):
            part = anchors.iloc[start : start + AT_ONCE]
            q = _numbers(part["x"])
            low, high = intervals(q, self.bits, self.alignments, self.rest, self.lengths)
            yield from zip(part.itertuples(index=False), q, low, high)

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return products(np.broadcast_to(q, (len(at), len(q))), self.x[at])


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _positives(k: int):
    def compare(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            block = _Block(rows)
            for anchor, q, low, high in block.bounds(anchors):
                other = np.flatnonzero(block.ids != anchor.id)
                at = other[high[other] >= _kth(low[other], k)]
                scores = block.scores(q, at)
                for j in np.lexsort((block.ids[at], -scores))[:k]:
                    out.append((anchor.id, block.ids[at[j]], scores[j]))
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])

    return compare


def _negatives(k: int, percent: tuple[int, int]):
    least, most = percent

    def compare(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            block = _Block(rows)
            for anchor, q, low, high in block.bounds(anchors):
                other = block.labels != anchor.label
                wanted = np.zeros(len(other), bool)
                windows = [(s, -(-least * s // 100), most * s // 100) for s in sorted({int(s) for s in anchor.scores})]
                windows = [w for w in windows if w[1] <= w[2]]
                for _, bottom, top in windows:
                    sure = other & (low >= bottom) & (high <= top)
                    wanted |= other & (low <= top) & (high >= max(bottom, _kth(low[sure], k)))
                at = np.flatnonzero(wanted)
                scores, ids = block.scores(q, at), block.ids[at]
                for s, bottom, top in windows:
                    fit = np.flatnonzero((scores >= bottom) & (scores <= top))
                    for j in fit[np.lexsort((ids[fit], -scores[fit]))[:k]]:
                        out.append((anchor.id, s, ids[j], scores[j]))
        return pd.DataFrame(out, columns=["anchor_id", "positive_score", "negative_id", "negative_score"])

    return compare


def _coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, part in batch.groupby(batch["vector"].map(len)):
            x = np.stack(part["vector"].to_numpy())
            with np.errstate(all="ignore"):
                bits, alignments, rest = encode(x)
            blobs = {c: [r.tobytes() for r in a] for c, a in (("x", x), ("bits", bits), ("alignments", alignments))}
            yield part[["id", "label"]].assign(dim=x.shape[1], **blobs, rest=rest)


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str], compare, schema: str) -> DataFrame:
    """``compare`` on each block of rows with each block of anchors that share ``keys``."""
    many = lambda df, n, each: df.groupBy(*keys).agg(F.ceil(F.count("*") / each).cast("int").alias(n)).filter(F.col(n) > 1)
    sizes = many(rows, "n", BLOCK_ROWS).join(many(anchors, "m", BLOCK_ANCHORS), keys, "full")
    sizes = stored(sizes.select(*keys, F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("m", F.lit(1)).alias("m")), "blocks")
    n, m = F.coalesce("n", F.lit(1)), F.coalesce("m", F.lit(1))
    mine = lambda c: F.pmod(F.xxhash64("id"), c).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    left = rows.join(sizes, keys, "left").withColumn("i", mine(n)).select(*rows.columns, "i", every(m).alias("j"))
    right = anchors.join(sizes, keys, "left").withColumn("j", mine(m)).select(*anchors.columns, "j", every(n).alias("i"))
    by = [*keys, "i", "j"]
    # Renamed, as both sides come from one table.
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (left, right))
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(compare, schema)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the integer product of two vectors whose components are floored after multiplication by ``scale``.
    Anchors are the rows where ``is_anchor`` holds, a condition on the id. Of the other rows with an anchor's
    label, the ``positives`` that score highest are its positives; for each, the ``negatives`` highest rows of another label are returned whose score
    lies between the two ``percent`` of the positive's. Ties go to the smaller id; fewer are returned where there are
    fewer. A positive score below zero admits none.

    Rows without an id or label, and vectors that are null, empty or hold null or non-finite components, take no part.
    Vectors are compared with those of equal length. Of rows that share an id, that with the least
    label and vector counts. Scores beyond the largest long, or that below zero, count as these. Other columns are not looked at.
    """
    huge = F.lit(float(np.finfo(np.float64).max))
    floored = F.transform("vector", lambda x: F.when(F.abs(x) >= 2.0**52, F.greatest(-huge, F.least(huge, x * scale))).otherwise(F.floor(x * scale).cast("double")))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= huge))
    used = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    used = used.filter("id is not null and label is not null and size(vector) > 0").filter(F.coalesce(finite, F.lit(False)))
    used = used.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")
    coded = used.withColumn("vector", floored).mapInPandas(
        _coded, "id bigint, label bigint, dim bigint, x binary, bits binary, alignments binary, rest double"
    )
    coded = stored(coded, "codes")
    asked = coded.select(F.col("id").alias(id_col), "*").filter(is_anchor).select("id", "label", "dim", "x")

    near = _met(coded, asked, ["dim", "label"], _positives(positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = stored(near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives).drop("nth"), "positives")

    lists = near.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    found = _met(
        coded, asked.join(lists, "id"), ["dim"], _negatives(negatives, percent),
        "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    out = near.join(found, ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
