"""Quality of texts: histogram gradient-boosted trees over document statistics.

The statistics of a bounded sample of labelled rows go to the driver, where trees are grown on
binned columns. The trees are then flattened into arrays, and whole batches walk down all of them
at once with numpy.
"""

from __future__ import annotations

import operator
import sys
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_COMMON = np.zeros(256, bool)
_COMMON[[*b".,;:'\"-()?"]] = True
_ODD = ~(_LETTER | _DIGIT | _BLANK | _COMMON)

STATISTICS = [
    "log_bytes", "log_words", "word_length", "upper", "digits", "odd", "common_marks", "blanks", "distinct_words",
    "distinct_pairs", "top_word", "same_next", "upper_words", "odd_ends", "odd_words", "line_length", "longest_line",
    "distinct_lines", "ended_lines", "longest_run", "long_words", "bangs",
]


def statistics(text: str | None) -> list[float]:
    """Counts and shares of one whole text, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    size, letters = len(raw), max(1, int(counts[_LETTER].sum()))
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    lengths = Counter(map(len, words))
    tally = Counter(words)
    ends = Counter(w[-1] for w in words)
    plain = sum(v for c, v in ends.items() if c.isalnum() or c in ".,;:'\"-()?")
    alone = sum(v for w, v in tally.items() if not any(map(str.isalpha, w)))
    turns = np.flatnonzero(np.diff(raw)) if size > 1 else np.empty(0, np.int64)
    runs = np.diff(np.concatenate(([-1], turns, [size - 1])))
    full = [x for x in lines if x.strip()]
    m = max(1, len(full))
    return [
        np.log1p(size), np.log1p(len(words)), sum(k * v for k, v in lengths.items()) / n, counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / size, counts[_ODD].sum() / size, counts[_COMMON].sum() / size, counts[_BLANK].sum() / size,
        len(tally) / n, len(set(zip(words, words[1:]))) / n, max(tally.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n, sum(v for w, v in tally.items() if w.isupper() and len(w) > 1) / n, 1 - plain / n,
        alone / n, np.log1p(size / m), np.log1p(max(map(len, full), default=0)), len(set(full)) / m,
        sum(x.rstrip()[-1] in ".!?\"'" for x in full) / m, np.log1p(runs.max()), sum(v for k, v in lengths.items() if k > 25) / n,
        counts[33] / size,
    ]


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))


class Trees:
    """Boosted trees as flat arrays; node 0 of tree ``t`` is ``roots[t]``, leaves point to themselves."""

    def __init__(self, base: float):
        self.base, self.roots, self.depth = base, [], 0
        self.column, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def add(self) -> int:
        k = len(self.value)
        for items, new in ((self.column, 0), (self.cut, np.inf), (self.left, k), (self.right, k), (self.value, 0.0)):
            items.append(new)
        return k

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        if self.roots and len(x):
            column, cut, left, right, value = (np.asarray(a) for a in (self.column, self.cut, self.left, self.right, self.value))
            at = np.tile(np.asarray(self.roots), (len(x), 1))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = np.where(x[rows, column[at]] <= cut[at], left[at], right[at])
            total = total + value[at].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(
    x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: float = 8.0
) -> Trees:
    """Fit trees to labels ``y`` (0 or 1) by gradient and curvature histograms of binned columns.

    Without rows the score is 0.5; with labels of one kind it is their smoothed share.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    trees = Trees(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return trees
    trees.depth = depth
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    total = np.full(len(y), trees.base)
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        root = trees.add()
        trees.roots.append(root)
        node = np.zeros(len(y), np.int64)  # place among the open nodes
        names, where = [root], np.full(len(y), root)
        for _ in range(depth):
            n = len(names)
            best = [(1e-6, -1, -1)] * n
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                code, width = node * bins + binned[:, j], bins
                g = np.bincount(code[node >= 0], slope[node >= 0], n * width).reshape(n, width).cumsum(axis=1)
                h = np.bincount(code[node >= 0], bend[node >= 0], n * width).reshape(n, width).cumsum(axis=1)
                gl, hl, ga, ha = g[:, : len(e)], h[:, : len(e)], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < least / 4) | (ha - hl < least / 4)] = -1
                top = gain.argmax(axis=1)
                for i in range(n):
                    if gain[i, top[i]] > best[i][0]:
                        best[i] = (gain[i, top[i]], j, int(top[i]))
            following, moved = [], np.full(len(y), -1, np.int64)
            for i, (_, j, b) in enumerate(best):
                if j < 0:
                    continue
                k, left, right = names[i], trees.add(), trees.add()
                trees.column[k], trees.cut[k], trees.left[k], trees.right[k] = j, float(edges[j][b]), left, right
                here = node == i
                goes = here & (binned[:, j] <= b)
                moved[goes], moved[here & ~goes] = len(following), len(following) + 1
                where[goes], where[here & ~goes] = left, right
                following += [left, right]
            names, node = following, moved
            if not names:
                break
        leaves, at = np.unique(where, return_inverse=True)
        values = rate * np.bincount(at, slope) / (np.bincount(at, bend) + ridge)
        for k, v in zip(leaves, values):
            trees.value[k] = float(v)
        total = total + values[at]
    return trees


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 20_000) -> Trees:
    """Trees for the labelled rows; of more than ``max_rows`` those with the smallest hash of their id.

    Rows without an id or with a label other than 0 and 1 are left out; null and empty texts count as empty ones. An id
    that several documents or labels have gives a row for each of their pairs, which count within ``max_rows``. Without
    documents or labels every score is 0.5, with labels of one kind their smoothed share. Other columns are not read,
    whatever their names.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")).filter("_id is not null and _y in (0, 1)")
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows)

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(matrix(texts)))

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # At most max_rows rows of two columns.
    found = texts.join(F.broadcast(sample), "_id").select("_id", "_y", measured("_text").alias("x")).orderBy("_id").limit(max_rows)
    rows = found.toPandas()
    x = np.array(list(rows["x"]), float).reshape(len(rows), len(STATISTICS))
    return grow(x, rows["_y"].to_numpy(float))


def score(text: Column | str, trees: Trees) -> Column:
    """Probability of label 1 of each whole text; null counts as empty. A column expression: repeated rows get equal scores, a
    table without rows stays so, and no other column is read or added."""

    @F.pandas_udf("double")
    def walk(texts: pd.Series) -> pd.Series:
        return pd.Series(trees.score(matrix(texts)))

    return walk(F.col(text) if isinstance(text, str) else text)
