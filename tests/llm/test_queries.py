"""Registered queries of this folder against SQL, and the pipeline's stages against plain rules."""

import random
import subprocess
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import quality, queries
from tidemark.llm.common import stored, table
from tests.llm.test_operators import WORDS, plain_groups, plain_leaks, plain_lines, prose
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_same_as_sql(spark, key):
    assert compare(spark, connect(FOLDER), FOLDER, key, queries.QUERIES[key], queries.SQL[key]) is None


@pytest.mark.parametrize(("key", "label", "fold", "part"), [("op5_quality_classifier", "quality", 5, 0), ("op7_toxicity", "toxic", 4, 2)])
def test_classifiers_on_held_out_rows(spark, key, label, fold, part):
    folder = "/root/testdata/sf0.01"
    scored = queries.QUERIES[key](spark, folder).toPandas()
    found = duckdb.sql(f"SELECT doc_id, held_out, predicted, {label} AS y FROM scored JOIN '{folder}/labels.parquet' USING (doc_id) WHERE held_out").fetchall()
    import zlib

    assert all(zlib.crc32(str(i).encode()) % fold == part for i, *_ in found)
    assert sum(p == y for _, _, p, y in found) >= 0.9 * len(found)


def test_neighbours_recall(spark):
    folder = "/root/testdata/sf0.01"
    got = {}
    for r in queries.QUERIES["op2_nearest_neighbours"](spark, folder).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = duckdb.sql(f"""
      SELECT q.vec_id, v.vec_id FROM '{folder}/embeddings.parquet' q JOIN '{folder}/embeddings.parquet' v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
      QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id) <= 5
    """).fetchall()
    assert sum(v in got[q] for q, v in rows) >= 0.9 * len(rows)


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    assert docs.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == before
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 1024").count() == 0


def test_pipeline_of_nothing(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_benchmarks_go_by_text(spark, tmp_path):
    items = [(1, "Which river runs past the old stone mill at night? The seven green carriages of morning."), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    leak = "before all of it " + items[0][1] + " and after it some more"
    rows = [(None, leak), (None, "clean"), (5, leak), (5, "clean too"), (6, None), (None, None), (7, ""), (None, leak)]
    docs = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id long")
    kept = corpus_pipeline.without_benchmarks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    want = [r for r in rows if r[1] != leak]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_stages_like_plain_python(spark, tmp_path):
    rng = random.Random(14)
    items = [(k, prose(rng, 20).capitalize() + ". " + prose(rng, 6).capitalize() + ".") for k in range(6)]
    base = [prose(rng, 80) for _ in range(5)]
    header = "\n".join(prose(rng, 5) for _ in range(3))
    rows = [(i, prose(rng, 60)) for i in range(20)] + [(100 + k, prose(rng, 30) + " " + t) for k, t in items[:4]]
    rows += [(200 + k, header + "\n" + prose(rng, 40)) for k in range(5)]
    for i in range(20):
        words = base[i % 5].split()
        for _ in range(rng.choice((0, 1, 2, 20))):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((300 + i, " ".join(words)))
    bad = [(400 + i, " ".join(w.upper() + "!!" for w in prose(rng, 50).split())) for i in range(40)]
    rows += bad + [(500, ""), (501, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(i, int(not 400 <= i < 500)) for i, _ in rows if i < 500]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))

    def run(stage, rows):
        docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
        return sorted((r.doc_id, r.text) for r in stage(spark, docs, str(tmp_path)).collect())

    good = run(corpus_pipeline.good_documents, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    used = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5]
    trees = quality.fit(docs, spark.createDataFrame(used, "doc_id long, quality int"))
    scores = trees.score(np.array([quality.statistics(t or "") for _, t in rows], float))
    key = lambda r: (r[0], r[1] or "")
    assert sorted(good, key=key) == sorted([r for r, x in zip(rows, scores) if x >= corpus_pipeline.LEAST_QUALITY], key=key)
    assert not {i for i, _ in good} & {i for i, _ in bad} and len(good) >= len(rows) - len(bad) - 2
    rows = [r for r in rows if r[1] is not None]
    assert run(corpus_pipeline.without_repeated_lines, rows) == sorted((i, t) for i, (t, _, _) in plain_lines(rows).items())
    kept = {i for i, (_, _, own) in plain_groups(rows, 5, 80).items() if own}
    assert run(corpus_pipeline.one_of_each_group, rows) == sorted(r for r in rows if r[0] in kept) and len(kept) < len(rows)
    found = {i for i, _ in plain_leaks(rows, items)}
    assert found == {100, 101, 102, 103}
    assert run(corpus_pipeline.without_benchmarks, rows) == sorted(r for r in rows if r[0] not in found)


def test_queries_without_a_package_that_these_need(tmp_path):
    code = (
        "import sys, warnings; warnings.simplefilter('ignore'); sys.modules['xxhash'] = None; import __spark_entry__ as e;"
        " print(len(e.queries()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))"
    )
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2])
    assert said.returncode == 0, said.stderr
    total, extra = map(int, said.stdout.split())
    assert total > 100 and extra == 0


def test_stages_keep_clashing_columns(spark, tmp_path):
    rng = random.Random(21)
    spark.createDataFrame([(1, prose(rng, 12) + ". " + prose(rng, 5) + ".")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(i, prose(rng, 40)) for i in range(8)] + [(None, None), (9, ""), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, len(t or ""), *[f"{i}"] * 6) for i, t in rows], "doc_id long, text string, n_chars long, _score string, _text string, _nth string, _suspect string, _digest string, _id string")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert out.columns == docs.columns
        assert all(x in (str(r.doc_id), None) for r in out.collect() for x in r[3:])
        assert out.count() == len(rows) - (name == "near_duplicates")
    assert corpus_pipeline.good_documents(spark, docs, str(tmp_path)).columns == docs.columns
