"""Hard negatives against integer scores of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

COLUMNS = "vec_id long, embedding array<double>, label int, anchor_id string, rank int, id string, scores string"


def plain(rows, scale=256, anchors=5):
    kept = {}
    for i, x, y in rows:
        if i is None or x is None or y is None or not x or any(v is None or not np.isfinite(v) for v in x):
            continue
        kept[i] = min(kept.get(i, (y, x)), (y, x))
    ints = {i: [int(np.floor(v * scale)) if abs(v) < 1e300 else int(np.sign(v) * np.finfo(float).max) for v in x] for i, (y, x) in kept.items()}
    clamp = lambda s: max(-(2**63 - 1), min(2**63 - 1, s))
    out = []
    for a in sorted(kept):
        if a % anchors:
            continue
        score = {j: clamp(sum(p * q for p, q in zip(ints[a], ints[j]))) for j in kept if len(ints[j]) == len(ints[a])}
        ranked = sorted((j for j in score if j != a), key=lambda j: (-score[j], j))
        for p in [j for j in ranked if kept[j][0] == kept[a][0]][:5]:
            fit = [j for j in ranked if kept[j][0] != kept[a][0] and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(a, p, k + 1, j, score[p], score[j]) for k, j in enumerate(fit[:3])]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], COLUMNS)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0).collect())


def vectors(rng, n, dim, labels):
    centers = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    x = centers[label] * 0.6 + rng.normal(size=(n, dim))
    return [(i, row.tolist(), int(y)) for i, (row, y) in enumerate(zip(x / np.sqrt(dim), label))]


@pytest.mark.parametrize(("n", "dim", "labels"), [(200, 16, 3), (150, 70, 4), (60, 3, 2), (40, 1, 2)])
def test_same_as_all_pairs(spark, n, dim, labels):
    rows = vectors(np.random.default_rng(n), n, dim, labels)
    got = found(spark, rows)
    assert got == plain(rows) and got


def test_blocks_give_the_same(spark, monkeypatch):
    rows = vectors(np.random.default_rng(9), 260, 8, 3)
    # A label with half of all rows, of which most are one vector.
    rows += [(1000 + i, rows[0][1], 1) for i in range(250)]
    want = plain(rows)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 16)
    monkeypatch.setattr(negatives, "AT_ONCE", 5)
    assert found(spark, rows) == want


def test_intervals_hold_the_scores():
    rng = np.random.default_rng(4)
    for dim in (1, 2, 33, 64, 130):
        x = np.floor(rng.normal(size=(80, dim)) * 300)
        x[3], x[4] = 0, x[5]
        bits, alignments, rest = negatives.encode(x)
        low, high = negatives.intervals(x[:9], bits, alignments, rest, np.sqrt((x * x).sum(axis=1)))
        scores = x[:9] @ x.T
        assert (low <= scores).all() and (scores <= high).all()
        if dim == 64:
            norms = np.sqrt((x * x).sum(axis=1))
            some = norms > 0  # row 3 has no length, as an anchor neither
            assert ((high - low)[some[:9]][:, some] / (norms[:9, None] * norms)[some[:9]][:, some]).mean() < 0.5


def test_nulls_ties_repeats_and_huge_numbers(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 60, 8, 3)
    nan, inf = float("nan"), float("inf")
    rows += [(None, rows[0][1], 1), (100, None, 1), (105, rows[0][1], None), (110, [nan] * 8, 1), (115, [inf] + [0.0] * 7, 1), (120, [None] + [0.0] * 7, 1)]
    rows += [(125, [], 1), (130, [0.0] * 8, 1), (131, [0.0] * 8, 2), (5, rows[5][1], rows[5][2]), (5, rows[6][1], 7), (140, [1.0, 2.0], 1), (141, [1.0, 1.5], 1), (142, [0.7, 1.2], 2)]
    rows += [(200 + i, rows[i % 3][1], i % 2) for i in range(20)]
    rows += [(300 + i, [1e30 * (i + 1)] + [0.5] * 7, i % 2) for i in range(6)] + [(310, [1.7e308] * 8, 0), (315, [-1.7e308] + [1.0] * 7, 1)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == [] and found(spark, rows[:1]) == []
