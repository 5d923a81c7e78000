"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.test_operators import frame, prose
from tidemark.llm import queries, runs


def plain_runs(words, least=12):
    n, out = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            part = words[start : i + p]
            if len(part) >= max(least, 2 * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                out.append((start, len(part), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    words = [rng.choice("abcdefghij"[: rng.choice((1, 2, 3, 4, 10))]) for _ in range(rng.randint(0, 90))]
    if rng.random() < 0.7 and len(words) > 3:
        a = rng.randrange(len(words))
        p = rng.randint(1, max(1, (len(words) - a) // 2))
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    if rng.random() < 0.3:
        words += [rng.choice("abc") for _ in range(rng.randint(1, 30))] * rng.randint(2, 5)
    return words


def test_all_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(300):
        texts = [some_words(rng) for _ in range(rng.randint(1, 6))]
        got = dict(runs._searched([[w.encode() for w in t] for t in texts], 12))
        for i, words in enumerate(texts):
            found = [(int(s), int(e - s), int(p)) for s, e, p in got.get(i, ())]
            assert found == plain_runs(words), words


def test_wavelet_tree_counts_and_orders():
    rng = np.random.default_rng(3)
    values = rng.permutation(500)[:300]
    tree = runs.WaveletTree(values, 10)
    low = rng.integers(0, 300, 200)
    high = low + rng.integers(0, 301 - low)
    bound = rng.integers(0, 600, 200)
    assert tree.below(low, high, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
    some = high > low
    nth = rng.integers(0, 1 << 30, 200) % np.maximum(1, high - low)
    got = tree.smallest(low[some], high[some], nth[some])
    assert got.tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(low[some], high[some], nth[some])]


def test_block_names_are_equal_for_equal_blocks():
    rng = random.Random(2)
    sequence = np.array([rng.randint(1, 2) for _ in range(60)] + [0])
    names = runs.block_names(sequence)
    for k, name in enumerate(names[:-1]):
        blocks = [tuple(sequence[i : i + (1 << k)]) for i in range(len(sequence))]
        assert len({*zip(name.tolist(), blocks)}) == len(set(name.tolist())) == len(set(blocks))
    assert np.argsort(names[-1]).tolist() == sorted(range(61), key=lambda i: sequence[i:].tolist())


@pytest.mark.parametrize("text", ["a " * 30000, " ".join(["x y z"] * 9000), "w" * 300_000])
def test_very_long_texts(spark, text):
    row = runs.periodic_runs(frame(spark, [(1, text)])).first()
    words = text.split()
    period = len(set(words))
    want = [(0, len(words), period)] if len(words) > 12 else []
    assert [tuple(r) for r in row.runs] == want and row.n_words == len(words)
    assert row.collapsed == " ".join(words[:period])


def test_nulls_repeats_and_clashing_names(spark):
    rng = random.Random(8)
    texts = [None, "", " \t\n", "one", "la " * 11, "la " * 12, "a b c\n" * 7, "X y\r\nX  y " * 6 + "é", prose(rng, 300)]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, "la " * 13)]
    docs = frame(spark, rows)
    for name in ("runs", "n_words", "collapsed", "judged"):
        docs = docs.selectExpr("*", f"7 AS {name}")
    out = runs.periodic_runs(docs)
    assert out.columns == [c for c in docs.columns if c not in ("runs", "n_words", "collapsed")] + ["n_words", "runs", "collapsed"]
    got = sorted((repr((r.doc_id, r.text)), r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.judged) for r in out.collect())
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        found = plain_runs(words)
        want.append((repr((i, t)), len(words), found, plain_collapsed(words, found), 7))
    assert got == sorted(want)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_short_runs_are_refused(spark):
    with pytest.raises(ValueError, match="nine"):
        runs.periodic_runs(frame(spark, [(1, "a")]), least=4)


def test_query_like_plain_python(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, " ".join(some_words(rng)) if i % 2 else prose(rng, rng.randint(0, 60))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "a " * 20), (7, "b " * 40), (7, "b " * 40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want, planted = [], 0
    for i, text in rows:
        words = (text or "").split()
        n, h = len(words), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (j - a) % p] for j in range(a, n)]
            planted += 1
        found = plain_runs(words)
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in found)
        want.append((i, len(found), *top, None if top[0] is None else 1000 * top[1] // top[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapsed(words, found)))))
    got = [tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and planted > 5
