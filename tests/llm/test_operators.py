"""Each operator against plain Python on small tables with nulls, ties, repeats and clashing names."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, licences, lines, minhash, neighbours, packing, quality, suffixes, toxicity, warc
from tidemark.llm.common import components, may_be_among

#: Columns that clash with names the operators add or use.
DOCS = "doc_id long, text string, n_lines long, v string, id string, score double, first long"
WORDS = "the of and with river stone light under open field seven carry window slowly paper green night morning".split()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x", "y", 0.5, 3) for i, t in rows], DOCS)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    """Ids and texts: near copies, exact copies, shared passages, empty, null, one word, one long text."""
    rng = random.Random(4)
    out, base = [], [prose(rng, 120) for _ in range(6)]
    for i in range(60):
        words = base[i % 6].split()
        for _ in range(rng.choice((0, 1, 3, 6, 30))):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        out.append((i, " ".join(words)))
    passage = prose(rng, 20)
    out += [(100 + i, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30)) for i in range(8)]
    out += [(200, base[0]), (201, base[0]), (202, ""), (203, None), (204, "one"), (205, "two words"), (206, "é" * 120 + " " + passage)]
    out += [(207, prose(rng, 4000)), (208, " \t\n"), (209, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a")]
    return out


# -------------------------------------------------------------------------- components


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    links = spark.createDataFrame(random.Random(1).sample(chain + star, len(chain) + len(star)) + [(500, 500)], "a long, b long")
    roots = {r.v: r.root for r in components(links).collect()}
    assert {roots[i] for i in range(41)} == {0} and {roots[100 + i] for i in range(30)} == {100}


# ---------------------------------------------------------------------------- licences


def test_licences_whole_and_lines(spark):
    mit = dict(reversed(licences.KNOWN))["MIT"]
    full = next(t for i, t in licences.KNOWN if i == "MIT" and len(t) > 500)
    rows = [
        (1, full), (2, "Copyright (c) 2020 A. Person\n\n" + full.upper().replace(" ", "  ")), (3, full.replace("sublicense", "sub-licence")),
        (4, full + " More."), (5, "Some text.\nReleased under the MIT Licence!\nmore\nAll rights reserved"), (6, None), (7, ""), (8, "***"), (None, mit),
    ]
    got = {r.doc_id: r for r in licences.scan(frame(spark, rows), licences.known_digests(spark)).collect()}
    assert [got[i].license_id for i in (1, 2, 3, 4, 5)] == ["MIT", "MIT", "MIT", None, None]
    assert got[5].notices == "LicenseRef-reserved,MIT" and got[1].notices is None
    assert got[6].digest is got[7].digest is got[8].digest is None
    assert got[None].license_id == "MIT" and got[None].notices is None
    assert licences.scan(frame(spark, []), licences.known_digests(spark)).count() == 0


def test_licences_at_any_width(spark):
    import textwrap

    long = {}
    for i, t in licences.KNOWN + licences.whole_texts():
        if len(t) > len(long.get(i, "x" * 400)) and not i.startswith("GPL"):
            long[i] = t
    assert set(long) >= {"MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"}
    gpl = max((t for i, t in licences.whole_texts() if i == "GPL-3.0"), key=len)
    long["GPL-3.0"] = gpl[: gpl.index("END OF TERMS")]
    head = {"BSD-2-Clause": "Copyright (c) 2020, A. Person\nAll rights reserved.\n\n", "MIT": "Copyright Jane Doe\n\n", "ISC": "© Jane Doe\nCopyright Jim Doe\n"}
    widths, rows, want = (30, 47, 60, 72, 100, 10_000), [], []
    for i, t in long.items():
        for width in widths:
            parts = [textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in t.split("\n\n")]
            # Notices of the text itself keep their lines.
            parts = [p if "copyright (c)" in p.lower() or "Copyright [yyyy]" in p else q for p, q in zip(t.split("\n\n"), parts)]
            rows.append((len(rows), head.get(i, "") + "\n\n".join(parts)))
            want.append(i)
    rows += [(len(rows), "(c) You must keep this"), (len(rows) + 1, "Terms.\nCopyright holders say.\nAll rights reserved.")]
    got = {r.doc_id: r for r in licences.scan(frame(spark, rows), licences.known_digests(spark)).collect()}
    assert [(i, widths[k % len(widths)]) for k, i in enumerate(want) if got[k].license_id != i] == []
    assert got[len(want)].digest == hashlib.sha256(b"c you must keep this").hexdigest()
    assert got[len(want) + 1].digest == hashlib.sha256(b"terms copyright holders say all rights reserved").hexdigest()


# -------------------------------------------------------------------------- neighbours


def exact(rows, queries, k):
    ok = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in queries:
        if q in ok:
            a = ok[q]
            near = [(-float(a @ b / np.sqrt((a @ a) * (b @ b))), i) for i, b in ok.items() if i != q and len(b) == len(a)]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def test_neighbours_with_copies_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)] + [(400 + i, [2 * x for x in rows[6][1]]) for i in range(9)]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [None] * 16), (504, []), (505, [1.0, 2.0]), (506, [2.0, 1.0])]
    schema = "vec_id long, embedding array<double>, rank int, score string"
    vectors = spark.createDataFrame([(i, v, 1, "s") for i, v in [*rows, rows[0]]], schema)
    queries = [i for i, _ in rows if i % 20 == 0 or i >= 500]
    got = defaultdict(list)
    for r in neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0 or vec_id >= 500")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = exact(rows, queries, 5)
    assert set(got) == {q for q, v in want.items() if v}
    assert [len(got[q]) for q in got] == [len(want[q]) for q in got]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in got)
    assert hits >= 0.9 * sum(map(len, got.values()))
    # The 41 equal vectors: smallest ids first, itself left out.
    assert [i for i, _ in got[300]] == [5, 301, 302, 303, 304]


def test_neighbours_of_few_rows(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.vec_id) for r in neighbours.nearest(few, few.filter("vec_id = 1")).orderBy("rank").collect()]
    assert got == [(1, 3), (1, 2)]
    assert neighbours.nearest(few.limit(0), few.limit(0)).count() == 0


def test_second_hash_keeps_buckets_small():
    assert neighbours.coarse_axes(50_000, 64) == 0
    assert [neighbours.coarse_axes(n, 64) for n in (200_000, 1_000_000, 10**9)] == [2, 16, 64]
    x = np.random.default_rng(0).normal(size=(50, 64))
    got = neighbours.buckets(x / np.linalg.norm(x, axis=1, keepdims=True), 16, 3, 1)
    assert got.shape == (50, neighbours.TABLES, 3) and (got[:, 0, 0] != got[:, 0, 1]).all()


def test_second_hash_keeps_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BUCKET_ROWS", 2)
    assert neighbours.coarse_axes(3000, 64) == 8
    x = np.random.default_rng(11).normal(size=(3000, 64))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0")).collect()}
    want = exact([(i, v.tolist()) for i, v in enumerate(x)], range(0, 3000, 20), 5)
    assert sum((q, i) in got for q in want for i, _ in want[q]) >= 0.9 * 5 * len(want)


@pytest.mark.parametrize("rows", [200_000, 1_000_000, 30_000_000])
def test_probes_follow_the_second_hash(rows):
    probes, axes = neighbours.enough_probes(rows, 64, 5, neighbours.PROBES, 2), neighbours.coarse_axes(rows, 64)
    rng, c = np.random.default_rng(12), neighbours.random_cosine(5 / rows, 64)
    x, z = rng.normal(size=(2, 400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z, axis=1, keepdims=True)
    assert (neighbours.buckets(x, axes, 1, 2) == neighbours.buckets(y, axes, probes, 2)).any(axis=(1, 2)).mean() > 0.9


# -------------------------------------------------------------------------------- warc


def digest(data):
    import base64

    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("split", ["128m", "300b"])
def test_archive_round_trip(spark, tmp_path, split):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bodies = ["<p>one</p>", "", None, inner, "a" + inner * 3 + "WARC/1.", "é漢" * 300, "<p>one</p>", "\r\n\r\n", "WARC/1.1\r\n", "WWARC/1.1\r\nx", "<p>one</p>"]
    rows = [(i, f"http://x/{i} a\r\nb", b, "c") for i, b in enumerate(bodies)] + [(None, None, "<p>one</p>", "c"), (20, "u", "zz", "c"), (20, "u", "zz", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = str(tmp_path / "archive")
    warc.write_archive(pages.repartition(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archive(spark, path, payload=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = Counter()
    first = {}
    for i, _, b, _ in rows:
        if i is not None:
            first[b or ""] = min(i, first.get(b or "", i))
    for i, _, b, _ in rows:
        data = (b or "").encode()
        own = i == first[b or ""]
        want[i, len(data), digest(data), "response" if own else "revisit", None if own else first[b or ""], data if own else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.record_type == "revisit" else bytes(r.payload)) for r in got) == want
    assert all("\n" not in (r.url or "") for r in got)


def test_archive_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_only_the_chain_counts(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    fake = record.format(7, 3, "xyz")
    good = record.format(1, len(fake), fake) + record.format(2, 2, "ok") + record.format(3, 999, "cut")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc").write_bytes(good.encode())
    (tmp_path / "a" / "two.warc").write_bytes(b"junk" + record.format(4, 1, "q").encode())
    got = {r.page_id: (r.offset, r.payload_bytes) for r in warc.read_archive(spark, str(tmp_path / "a")).collect()}
    assert set(got) == {1, 2, 3} and got[1] == (0, len(fake)) and got[2][1] == 2


# ----------------------------------------------------------------------------- packing


def test_pieces_are_the_tokenizers(spark, documents):
    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    odd = ["x<|endoftext|>y", "日本語 text ½ ² ª", "a b\x1cc", "don't  stop\n\n  now_it's 12345 $$$", "퟿ ok", "Ünïcödé ×÷ ß"]
    rows = documents + [(300 + i, t) for i, t in enumerate(odd)] + [(None, "null id")]
    tokenizer = Tokenizer.from_file(path)
    got = defaultdict(dict)
    for r in packing.pieces(frame(spark, rows), path, ranks, capacity=64).collect():
        got[r.doc_id][r.piece] = (r.start, r.length, np.frombuffer(bytes(r.ids), "<u4").tolist())
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        pieces = [got[i][k] for k in range(len(got[i]))]
        assert sum((p[2] for p in pieces), []) == ids
        assert all(p[1] == 64 for p in pieces[1:]) and 1 <= pieces[0][1] <= 64
        assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:k]) for k in range(len(pieces))]


def best_fit(lengths, capacity):
    """Sequences that best-fit decreasing opens."""
    import bisect

    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(rooms, x)
        n += k == len(rooms)
        bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - x)
    return n


def test_packed_sequences_have_no_gaps(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice((1, 5, 40, 64, rng.randint(1, 64))), "s", 1) for i in range(3000)]
    made = spark.createDataFrame(rows + rows[:3], "doc_id long, length int, sequence_id string, offset int")
    got = packing.pack(made, capacity=64).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert len(got) == len(rows) + 3 and Counter((r.doc_id, r.length) for r in got) == Counter((i, n) for i, n, *_ in rows + rows[:3])
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= best_fit([r.length for r in got], 64)
    assert packing.pack(made.limit(0), capacity=64).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 65)], "doc_id long, length int"), capacity=64)


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_length_once(seed):
    rng = random.Random(seed)
    lengths = Counter(rng.choice((rng.randint(1, 1024), rng.randint(500, 700), 1024, rng.randint(1, 90))) for _ in range(rng.choice((0, 1, 50, 3000))))
    used, places = defaultdict(list), Counter()
    for length, low, high, first, offset, step in packing.fewest(lengths):
        places[length] += high - low
        for k in range(high - low):
            used[first + k // step].append((offset + k % step * length, length))
    assert places == lengths
    for placed in used.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024


# ----------------------------------------------------------------------------- quality


def test_quality_held_out(spark):
    rng = random.Random(5)
    good = [(i, prose(rng, rng.randint(20, 90)).capitalize() + ".") for i in range(150)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(rng, rng.randint(20, 90)).split())) for i in range(150)]
    docs = frame(spark, good + bad + [(None, "no id"), (5000, None), (5001, "")])
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad if i % 3] + [(None, 1), (7, None)], "doc_id long, quality int")
    trees = quality.fit(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", quality.score("text", trees).alias("s")).collect()}
    assert all((got[i] >= 0.5) == (i < 1000) for i, _ in good + bad)
    assert 0 <= got[5000] == got[5001] <= 1
    none = quality.fit(docs, labels.limit(0))
    assert none.score(np.zeros((2, len(quality.STATISTICS)))).tolist() == [0.5, 0.5]
    assert quality.fit(docs.limit(0), labels).roots == []


def test_trees_follow_their_arrays():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.grow(x, y, n_trees=30)
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.97
    assert len(quality.statistics("x" * 100_000)) == len(quality.statistics(" ")) == len(quality.STATISTICS)


# ------------------------------------------------------------------------------- lines


def plain_lines(rows, size=3):
    first, out = {}, {}
    for i, t in sorted((r for r in rows if r[1] is not None and r[0] is not None), key=lambda r: r[0]):
        x = t.split("\n")
        gone = set()
        for k in range(len(x) - size + 1):
            w = tuple(x[k : k + size])
            if first.setdefault(w, (i, k)) != (i, k):
                gone.update(range(k, k + size))
        out[i] = ("\n".join(line for k, line in enumerate(x) if k not in gone), len(x), len(gone))
    return out


def test_lines_like_plain_python(spark):
    rng = random.Random(6)
    pool = [prose(rng, 4) for _ in range(12)] + ["", "same"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice((1, 2, 3, 8, 40))))) for i in range(80)]
    rows += [(200, ""), (201, None), (202, "same\n" * 50), (203, rows[3][1]), (204, "\n\n\n\n")]
    out = lines.dedup_lines(frame(spark, [*rows, (None, "q\nr\ns"), (None, "q\nr\ns\nq\nr\ns")]))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.filter("doc_id is not null").collect()}
    want = plain_lines(rows) | {201: (None, 0, 0)}
    assert got == want
    assert sorted(r.n_removed for r in out.filter("doc_id is null").collect()) == [0, 3]
    assert set(out.columns) == set(frame(spark, []).columns) | {"n_removed"}
    assert lines.dedup_lines(frame(spark, [])).count() == 0
    twice = lines.dedup_lines(frame(spark, [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in twice) == [(1, 0), (1, 0), (2, 3)]


def test_tree_walk_equals_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    x[::7, 2] = x[0, 2]
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = quality.grow(x, y, n_trees=12, depth=3)

    def walk(row, node):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.column[node]] <= trees.cut[node] else trees.right[node]
        return trees.value[node]

    plain = [1 / (1 + np.exp(-(trees.base + sum(walk(row, root) for root in trees.roots)))) for row in x]
    assert np.allclose(trees.score(x), plain, rtol=0, atol=1e-12)
    assert np.mean((trees.score(x) >= 0.5) == (y == 1)) > 0.9


def test_first_split_is_the_best_of_all():
    """With a bin for each value, the root's split has the greatest gain of all cuts of all columns, and leaves the values of their rows."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, size=(60, 4)).astype(float)
    y = (x[:, 1] + rng.normal(size=60) > 9).astype(float)
    ridge, rate, least = 2.0, 0.15, 8.0
    trees = quality.grow(x, y, n_trees=1, depth=1, rate=rate, bins=64, ridge=ridge, least=least)
    p = 1 / (1 + np.exp(-trees.base))
    slope, bend = y - p, np.full(60, p * (1 - p))

    def gain(rows):
        part = lambda m: slope[m].sum() ** 2 / (bend[m].sum() + ridge)
        if min(bend[rows].sum(), bend[~rows].sum()) < least / 4:
            return -1
        return part(rows) + part(~rows) - part(np.full(60, True))

    cuts = {(j, v): gain(x[:, j] <= v) for j in range(4) for v in np.unique(x[:, j])}
    root = trees.roots[0]
    found = x[:, trees.column[root]] <= trees.cut[root]
    assert gain(found) == pytest.approx(max(cuts.values()))
    for node, rows in ((trees.left[root], found), (trees.right[root], ~found)):
        assert trees.value[node] == pytest.approx(rate * slope[rows].sum() / (bend[rows].sum() + ridge))


def test_quality_of_repeated_rows_and_clashing_names(spark):
    good = [(i, "The committee met on Monday. It agreed on the plan, and on the costs.") for i in range(40)]
    bad = [(100 + i, "BUY NOW!!! $$$ click click click 1234567890") for i in range(40)]
    docs = spark.createDataFrame(good + bad + bad[:10], "doc_id long, text string").withColumn("_y", F.lit("x")).withColumn("_text", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad + good[:5]], "doc_id long, quality int").withColumn("x", F.lit(0))
    trees = quality.fit(docs, labels)
    got = docs.select("doc_id", quality.score("text", trees).alias("s")).collect()
    assert len(got) == 90 and all((r.s >= 0.5) == (r.doc_id < 100) for r in got)


# ---------------------------------------------------------------------------- toxicity


def test_restored_words():
    text = "you are an idiot and a moron said the pathetic clown to the stupid loser who is worthless trash and scum disgusting " * 20
    counts = np.bincount(toxicity._gram_codes(np.frombuffer(text.encode(), np.uint8)), minlength=toxicity.SYMBOLS**toxicity.ORDER)
    restorer = toxicity.Restorer(toxicity.language_model(counts.astype(float)))
    want = {"1d10t": "idiot", "m0r0n": "moron", "i d i o t": "idiot", "idiooot": "idiot", "p.a.t.h.e.t.i.c": "pathetic", "$tup1d": "stupid", "cl*wn": "clown"}
    assert {w: restorer.decode(w) for w in want} == want


def test_toxicity_of_plain_and_disguised(spark):
    rng = random.Random(7)
    clean = [(i, prose(rng, 60)) for i in range(200)]
    toxic = [(1000 + i, prose(rng, 30) + " you idiot moron " + prose(rng, 30)) for i in range(100)]
    odd = [(5000, "some 1d10t here"), (5001, "m o r o n indeed"), (5002, None), (5003, ""), (5004, "a " * 5000), (None, "idiooot")]
    docs = frame(spark, clean + toxic + odd)
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + toxic], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score("text", model).alias("s")).collect()}
    assert all((got[i] >= 0.3) == (i >= 1000) for i, _ in clean + toxic)
    assert got[5000] >= 0.3 and got[5001] >= 0.3 and got[None] >= 0.3 and max(got[5002], got[5003], got[5004]) < 0.3
    none = toxicity.fit(docs.limit(0), labels.limit(0))
    assert none.features == {} and none.score(set()) == 0.5


def test_every_disguise_is_decoded():
    text = "you are an idiot and a moron said the ass to the stupid loser who is worthless trash and scum disgusting " * 20
    counts = np.bincount(toxicity._gram_codes(np.frombuffer(text.encode(), np.uint8)), minlength=toxicity.SYMBOLS**toxicity.ORDER)
    lookup = toxicity.Lookup(toxicity.Restorer(toxicity.language_model(counts.astype(float))))
    idiot = [
        "!diot", "*diot", "an !diot!", "iddiioott", "i  d   i o  t", "i\td\ti\to\tt", "y.o.u.a.r.e.a.n...i.d.i.o.t.a.n.d.a...m.o.r.o.n.s.a.i.d.t.h.e.a.s.s.",
        "i" * 70 + "diot", "idi" + "o" * 500 + "t", "x." * 300 + "...i.d.i.o.t", "1d!0t!!!!", '"1d10t"',
    ]
    assert [t for t in idiot if not any("idiot" in w for w in lookup.words(t))] == []
    assert [t for t in ("a$$", "@$$", "a$$$", "4$$", "a s s", "a  $ $") if "ass" not in lookup.words(t)] == []
    assert "idiot" in lookup.words("y.o.u.a.r.e...i.d.i.o.t.")


# ----------------------------------------------------------------------------- minhash


def plain_groups(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_near_duplicates_like_plain_python(spark, documents, size, percent):
    rows = documents + [(300 + i, t.upper()) for i, t in documents[:9]]
    got = minhash.near_duplicates(frame(spark, rows), size=size, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == plain_groups(rows, size, percent)


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (9, None)]
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == Counter({(5, 3, False): 2, (3, 3, True): 1, (None, None, True): 1, (9, 9, True): 1})
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(2)
    both = rng.integers(0, 2**63, 800, dtype=np.uint64)
    one, two = np.unique(both[:700]), np.unique(both[100:])
    minima = minhash._signatures([one, two], 1000, 1)
    agree = (minima[0] & np.uint64(3) == minima[1] & np.uint64(3)).mean()
    assert abs((agree - 0.25) / 0.75 - 600 / 800) < 0.06
    assert minhash.least_agreeing(80, 2, 180) < 180 * 0.85


# ---------------------------------------------------------------------------- suffixes


def test_anchors_of_many_texts_at_once(monkeypatch):
    """The same as text by text, whatever lies beside a text; each string of a text has an anchor that its bytes alone choose."""
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"\0ab", k=rng.choice([0, 1, 23, 24, 49, 50, 51, 76, 200]))) for _ in range(60)] + [b"x" * 300, bytes(120)]
    monkeypatch.setattr(suffixes, "CACHED_BYTES", 1000)
    owner, at, h, c = suffixes.anchors(texts, 50)
    for k, raw in enumerate(texts):
        alone = suffixes.anchors([raw], 50)
        assert all((x[owner == k] == y).all() for x, y in zip((at, h, c), alone[1:]))
        for start in range(len(raw) - 49):
            own = set((suffixes.anchors([raw[start : start + 50]], 50)[1] + start).tolist())
            assert own and own <= set(at[owner == k].tolist())
    assert len(suffixes.anchors([], 50)[0]) == 0 == len(suffixes.anchors([b"", b"short"], 50)[0])


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    rng = random.Random(seed)
    for _ in range(300):
        t = [rng.randint(1, rng.choice((1, 2, 4))) for _ in range(rng.randint(0, 40))]
        assert suffixes.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def plain_repeats(rows, length=50):
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first.setdefault(b[s : s + length], i) < i:
                gone[s : s + length] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        out[i] = (len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("group_bytes", [1, 50, 200_000])
def test_strings_of_contexts_like_plain_python(group_bytes, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_BYTES", group_bytes)
    rng = random.Random(group_bytes)
    letters = lambda n: bytes(rng.choices(b"\x00ab", k=n))
    for _ in range(60):
        seen = {}
        for anchor in range(rng.randint(1, 5)):
            core = bytes(rng.choices(range(97, 123), k=suffixes.GRAM))
            sides = [(letters(26), letters(26)) for _ in range(2)]
            for _ in range(rng.randint(1, 7)):
                a, b = rng.choice(sides)[0][rng.randint(0, 26) :], rng.choice(sides)[1][: rng.randint(0, 26)]
                if rng.random() < 0.7:
                    a, b = letters(26 - len(a)) + a, b + letters(26 - len(b))
                if len(a) + len(b) >= 26:
                    seen[anchor, len(a), a + core + b] = rng.randint(0, 4)
        if not seen:
            continue
        rows, lowest = [(*k, v) for k, v in seen.items()], {}
        strings = [[(s, (a, p - s, c[s : s + 50])) for s in range(min(p, len(c) - 50) + 1)] for a, p, c, _ in rows]
        for mine, row in zip(strings, rows):
            for _, x in mine:
                lowest[x] = min(lowest.get(x, 9), row[3])
        want = {k: [s for s, x in mine if lowest[x] < rows[k][3]] for k, mine in enumerate(strings)}
        anchor, place, context, first = zip(*rows)
        found = suffixes._least(np.array(anchor), np.array(place), np.array(first), list(context), 50)
        assert {k: sorted(v.tolist()) for k, v in found} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("crowd", [5_000, 1])
def test_repeats_like_plain_python(spark, documents, crowd, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = random.Random(8)
    rows = list(documents)
    for i in range(40):  # patchworks of two texts that overlap in odd ways
        a, b = rows[rng.randrange(60)][1], rows[rng.randrange(60)][1]
        x, y = rng.randrange(len(a)), rng.randrange(len(b))
        rows.append((400 + i, a[x : x + rng.randint(30, 120)] + b[y : y + rng.randint(30, 120)]))
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixes.remove_repeats(frame(spark, rows)).collect()}
    assert got == plain_repeats(rows)


def test_repeats_odd_rows(spark):
    text = "x" * 30 + "0123456789" * 9
    got = suffixes.remove_repeats(frame(spark, [(1, text), (1, text), (2, text), (None, text), (3, None)])).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == Counter({(1, 0): 2, (2, len(text)): 1, (None, 0): 1, (3, 0): 1})
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0


def most_rows(df) -> int:
    """Runs ``df``; the most rows that a join or a generator of its plan made."""

    def walk(node) -> int:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        rows = node.metrics().get("numOutputRows")
        mine = rows.get().value() if ("Join" in name or "Generate" in name) and rows.isDefined() else 0
        return max([mine, *(walk(node.children().apply(k)) for k in range(node.children().size()))])

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_crowded_anchors_make_few_rows(spark, monkeypatch):
    """A line in many surroundings: like plain Python, and no step makes a row for each string of a context."""
    monkeypatch.setattr(suffixes, "CROWD", 40)
    rng = random.Random(12)
    line, ends = prose(rng, 12), [prose(rng, 3) for _ in range(4)]
    start = lambda: rng.choice([line[rng.randint(0, 30) :], prose(rng, 2) + rng.choice((" ", ". ", "\n")) + line])
    rows = [(i, start() + rng.choice((" ", ". ")) + rng.choice([*ends, prose(rng, 3)])) for i in range(600)]
    made, contexts, keep = [], [], suffixes.stored

    def stored(df, label, release=False):
        if label.startswith("crowded"):
            made.append(most_rows(df))
        out = keep(df, label, release)
        if label == "crowded-contexts":
            contexts.append(out.count())
        return out

    monkeypatch.setattr(suffixes, "stored", stored)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixes.remove_repeats(frame(spark, rows)).collect()}
    assert got == plain_repeats(rows)
    assert contexts[0] > 300 and 0 < max(made) <= 4 * contexts[0]


# ----------------------------------------------------------------------- decontaminate


def test_leaks(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, 25).capitalize() + ". " + prose(rng, 8).capitalize() + ".") for k in range(50)]
    rows = [(i, prose(rng, 300)) for i in range(30)]
    rows += [(100 + k, prose(rng, 77) + " " + items[k][1].upper() + " " + prose(rng, 90)) for k in range(20)]
    edited = items[30][1].split()
    edited[4] = "changed"
    rows += [(200, " ".join(edited)), (201, items[31][1].split(". ")[0]), (202, None), (203, ""), (None, items[32][1])]
    tests = spark.createDataFrame([*items, (90, None), (91, ""), (92, items[3][1]), items[4]], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), tests).collect())
    assert got == Counter([(100 + k, k) for k in range(20)] + [(103, 92), (200, 30), (None, 32)])
    assert decontaminate.leaks(frame(spark, []), tests).count() == decontaminate.leaks(frame(spark, rows), tests.limit(0)).count() == 0


def plain_leaks(rows, items, least=0.7, overlap=0.5):
    """Every passage of every document scored against every item, without an index."""
    import math
    import re

    known = sorted({(k, t) for k, t in items if t and t.split()})
    words = {x: x[1].encode().lower().split() for x in known}
    held = Counter(w for x in known for w in set(words[x]))
    idf = {w: math.log(1 + (len(known) - n + 0.5) / (n + 0.5)) for w, n in held.items()}
    mean, cell = sum(map(len, words.values())) / len(known), max(16, *map(len, words.values()))
    out = set()
    for x in known:
        damp = 1.2 * (0.25 + 0.75 * len(words[x]) / mean)
        impact = {w: idf[w] * n * 2.2 / (n + damp) for w, n in Counter(words[x]).items()}
        sentences = [t for t in re.split(r"(?<=[.?!])\s+|\n+", x[1]) if t.strip()]
        parts = [(" ".join(sentences[:-1]).encode().lower().split(), 5), (sentences[-1].encode().lower().split(), 3)]
        for i, t in rows:
            text = (t or "").encode().lower().split()
            for start in range(0, len(text), cell):
                passage = text[start : start + 2 * cell]
                score = sum(v for w, v in impact.items() if w in set(passage)) / sum(impact.values())
                shares = []
                for part, run in parts:
                    run = min(run, len(part))
                    there = {tuple(passage[j : j + run]) for j in range(len(passage) - run + 1)}
                    covered = {k for j in range(len(part) - run + 1) if tuple(part[j : j + run]) in there for k in range(j, j + run)}
                    shares.append(len(covered) / len(part))
                if score >= least and min(shares) >= overlap:
                    out.add((i, x[0]))
    return out


def test_leaks_like_scoring_all_passages(spark):
    rng = random.Random(13)
    items = [(k, prose(rng, rng.randint(8, 30)).capitalize() + ". " + prose(rng, rng.randint(4, 9)).capitalize() + ".") for k in range(25)]
    rows = []
    for i in range(60):
        words = items[i % 25][1].split()
        for _ in range(rng.choice((0, 1, 2, 4, 8))):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((i, " ".join([prose(rng, rng.randint(1, 90)), *words, prose(rng, rng.randint(1, 90))])))
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), tests).collect()}
    want = plain_leaks(rows, items)
    assert got == want and 20 < len(want) < 60


def test_retrieval_is_whole():
    rng = random.Random(10)
    words = [f"w{k}" for k in range(60)]
    index = decontaminate.Index([(k, " ".join(rng.choice(words) for _ in range(rng.randint(3, 20)))) for k in range(120)])
    for _ in range(200):
        terms = sorted({rng.randrange(len(index.terms)) for _ in range(rng.randint(1, 30))})
        least = rng.choice((0.2, 0.5, 0.8))
        scores = Counter()
        for t in terms:
            for item, impact in zip(*index.postings[t]):
                scores[item] += impact
        want = {k: s for k, s in scores.items() if s >= least + 1e-9}
        got = dict(index.retrieve(terms, least))
        assert want.keys() <= got.keys() and all(abs(got[k] - scores[k]) < 1e-9 for k in got)


def test_crc_of_packed_query(spark):
    made = packing.pieces(frame(spark, [(1, "hello")]), public_tokenizers.path("byte_bpe_50k.json")).selectExpr("ids", "crc32(ids) c").first()
    assert made.c == zlib.crc32(bytes(made.ids))


# ---------------------------------------------------------------------------- shared


def test_filter_lets_no_key_through_unseen(spark):
    keys = spark.createDataFrame([(i,) for i in range(0, 3000, 3)] + [(None,)], "k long")
    rows = spark.createDataFrame([(i,) for i in range(3000)] + [(None,)], "id long")
    got = {r.id for r in rows.filter(may_be_among(F.col("id"), keys)).collect()}
    assert got >= set(range(0, 3000, 3)) and None not in got and len(got) < 1100
    assert rows.filter(may_be_among(F.col("id"), keys.limit(0))).count() == 0


def test_own_names_clash_with_none(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(prose(rng, 4) for _ in range(6))) for i in range(4)]
    rows.append((9, rows[0][1]))
    docs = frame(spark, rows)
    for name in ("_id", "_later", "_cut", "_k", "_length", "_slice", "_n", "_score", "_suspect", "_digest", "_text"):
        docs = docs.selectExpr("*", f"concat('{name}', doc_id) AS {name}")
    cut = lines.dedup_lines(docs)
    assert cut.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert {(r._id, r._later, r._cut) for r in cut.collect()} == {(f"_id{i}", f"_later{i}", f"_cut{i}") for i, _ in rows}
    placed = packing.pack(docs.withColumn("length", F.lit(10)), capacity=25, order=("doc_id",))
    assert placed.columns == [*docs.columns, "length", "sequence_id", "offset"]
    assert {(r._k, r._length, r._slice) for r in placed.collect()} == {(f"_k{i}", f"_length{i}", f"_slice{i}") for i, _ in rows}
    assert sorted(r.offset for r in placed.collect()) == [0, 0, 0, 10, 10]


def test_leaks_the_same_in_parts(spark, monkeypatch):
    rng = random.Random(31)
    items = [(k, prose(rng, 12).capitalize() + ". " + prose(rng, 4).capitalize() + ".") for k in range(40)]
    rows = [(i, prose(rng, 30) + " " + items[i][1] + " " + prose(rng, 20)) for i in range(20)] + [(90, prose(rng, 50)), (91, None), (92, ""), (None, items[3][1])]
    for i in range(30, 40):  # edited copies, near the threshold
        words = items[i][1].split()
        words[rng.randrange(12)] = "other"
        rows.append((i, " ".join(words)))
    docs, tests = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "passages"]
    found = lambda: sorted(((-1 if r.doc_id is None else r.doc_id, *(round(x, 9) for x in r[1:])) for r in decontaminate.leaks(docs, tests).select(*columns).collect()))
    clean = lambda: sorted(repr(tuple(r)) for r in decontaminate.without_leaks(docs, tests).collect())
    one, kept = found(), clean()
    monkeypatch.setattr(decontaminate, "ITEMS", 11)
    assert found() == one and clean() == kept and len(one) >= 25
    leaking = {i for i, *_ in one}
    assert kept == sorted(repr(tuple(r)) for r in docs.collect() if (r.doc_id if r.doc_id is not None else -1) not in leaking)


# Marks between letters, marks without a width, wide letters, look-alikes, inner marks of ordinary words.
@pytest.mark.parametrize("word", [
    "i/d/i/o/t", "i,d,i,o,t", "i:d:i:o:t", "i=d=i=o=t", "i'd'i'o't", "i^d^i^o^t", "i%d%i%o%t", "i\u200bd\u200bi\u200bo\u200bt",
    "\uff49\uff44\uff49\uff4f\uff54", "\u0456d\u0456\u043et", "id=iot", "idi'ot", "id/iot", "id__iot",
])
def test_marks_and_lookalikes_are_undone(word):
    text = "you are an idiot and that is the end of it " * 50
    counts = np.bincount(toxicity._gram_codes(np.frombuffer(text.encode(), np.uint8)), minlength=toxicity.SYMBOLS**toxicity.ORDER)
    lookup = toxicity.Lookup(toxicity.Restorer(toxicity.language_model(counts.astype(float))))
    assert "idiot" in lookup.words(f"you are an {word} and")
    # Words of another script stay what they are.
    assert lookup.words("\u0434\u0438\u0430\u043b\u043e\u0433") == {"\u0434\u0438\u0430\u043b\u043e\u0433"}


@pytest.mark.parametrize("word", ["1d!0t", "a$$", "i.d.i", "heeello", "b4d", "sh1", "a-b", "6o+", "l00k"])
def test_viterbi_equals_all_readings(word, monkeypatch):
    """The decoder finds the likeliest of all readings, each scored by itself."""
    rng = np.random.default_rng(11)
    table = np.log(rng.dirichlet(np.ones(toxicity.SYMBOLS), toxicity.SYMBOLS ** (toxicity.ORDER - 1))).astype(np.float32)
    restorer = toxicity.Restorer(table)
    monkeypatch.setattr(toxicity, "BEAM", 10**9)
    steps, last, run = [], "", 0
    for c in [*word, None]:
        run = run + 1 if c == last else 1
        last = c or ""
        steps.append(restorer._options(c, run))
    best = (-np.inf, "")
    for reading in itertools.product(*steps):
        shown, written, score = [0, 0, 0], "", 0.0
        for symbol, letters, cost in reading:
            score += cost
            if symbol is None or symbol == 0 and shown[-1] == 0:
                continue
            a, b, c = shown[-3:]
            score += float(table[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c, symbol])
            # What lies before an edge is another word.
            shown = [0, 0, 0] if symbol == 0 else [*shown, symbol]
            written += letters
        best = max(best, (score, written))
    assert restorer.decode(word) == best[1].strip()
