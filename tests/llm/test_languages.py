"""Character models against plain Kneser-Ney, and predictions on texts held out."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import frame
from tidemark.llm import languages, queries

SYLLABLES = {"x": "ka to mi ru ne so ha".split(), "y": "sch ein ung ge ver tz lich".split(), "z": "ñé ção oui aux eau qué".split()}


def some_text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def codes(text):
    out = " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split())
    return "   " + out + " " if out else ""


def plain_model(texts):
    """Chance of a character after three others, by counts of strings."""
    counts = Counter(s[i - 4 : i] for s in map(codes, texts) for i in range(4, len(s) + 1))
    levels = {}
    for k in (4, 3, 2, 1):
        totals, kinds = Counter(), Counter()
        for g, n in counts.items():
            totals[g[:-1]] += n
            kinds[g[:-1]] += 1
        once, twice = (sum(n == v for n in counts.values()) for v in (1, 2))
        d = min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else 0.5
        levels[k] = counts, totals, kinds, d
        counts = Counter(g[1:] for g in counts)

    def chance(gram):
        p = 2.0**-16
        for k in (1, 2, 3, 4):
            counts, totals, kinds, d = levels[k]
            g = gram[4 - k :]
            if totals[g[:-1]]:
                p = max(0, counts[g] - d) / totals[g[:-1]] * (counts[g] > 0) + d * kinds[g[:-1]] / totals[g[:-1]] * p
        return p

    return chance


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    return [(i, some_text(rng, "xyz"[i % 3], rng.randint(3, 60)), "xyz"[i % 3]) for i in range(240)]


def with_lang(spark, rows):
    docs = frame(spark, [(i, t) for i, t, _ in rows]).withColumn("lang", F.lit("other")).drop("lang")
    return docs.join(spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, lang string"), "doc_id")


def test_costs_like_plain_counts(spark, texts):
    models = languages.fit(with_lang(spark, texts))
    assert models.names == ["x", "y", "z"]
    chances = [plain_model([t for _, t, y in texts if y == name]) for name in models.names]
    scorer = languages.Scorer(models)
    tried = [t for _, t, _ in texts[:12]] + ["Zzz qqq", "sch", "1 ein, 2!", "日本語 текст"]
    for _ in range(2):  # the second time from memory
        found, sizes = scorer.entropies(tried)
        for text, row, size in zip(tried, found, sizes):
            s = codes(text)
            assert size == len(s) - 3
            for got, chance in zip(row, chances):
                assert got == pytest.approx(-sum(math.log(chance(s[i - 4 : i])) for i in range(4, len(s) + 1)) / size, rel=1e-5)


def test_predictions_and_rejection(spark, texts):
    rng = random.Random(12)
    models = languages.fit(with_lang(spark, texts))
    new = [(i, some_text(rng, "xyz"[i % 3], 20), "xyz"[i % 3]) for i in range(90)]
    odd = [(100, "вот это русский текст для примера и ещё немного слов", None), (101, "qwxj zqvk wwqz jkxq qzzx vvkq", None)]
    none = [(200, None, None), (201, "", None), (202, "12 34 -- \n", None)]
    docs = spark.createDataFrame(new + odd + none, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in docs.select("doc_id", "lang", languages.predict("text", models).alias("p")).collect()}
    wrong = [(tuple(got[i].p), y) for i, _, y in new if got[i].p.lang != y or not 0.9 < got[i].p.score <= 1]
    assert not wrong and sum(got[i].p.rejected for i, *_ in new) <= 5, (wrong, models.mean, models.spread, models.beta)
    assert got[100].p.rejected and got[101].p.rejected and got[101].p.lang in "xyz"
    assert all(tuple(got[i].p) == ("und", 0.0, None, True) for i, _, _ in none)


def test_nothing_to_learn_from(spark, texts):
    rows = [(1, None, "x"), (2, "abc def", None), (3, "", "y"), (4, "123", "z")]
    for given in (rows, []):
        docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
        models = languages.fit(docs)
        assert models.names == []
        assert all(tuple(r.p) == ("und", 0.0, None, True) for r in docs.select(languages.predict("text", models).alias("p")).collect())
    # One text, one language; ties between languages with the same texts go to the first name.
    docs = spark.createDataFrame([(1, "abc def", "b"), (2, "abc def", "a")], "doc_id long, text string, lang string")
    models = languages.fit(docs)
    assert models.names == ["a", "b"]
    assert [r.p.lang for r in docs.select(languages.predict("text", models).alias("p")).collect()] == ["a", "a"]


def test_letters_and_sequences():
    letters = languages.Letters()
    assert letters.of("Ab, 1 Ç\n").tolist() == [97, 98, 32, 231, 32]
    assert letters.of(" a").tolist() == [97, 32] and len(letters.of("- 1")) == 0 and len(letters.of(None)) == 0
    beyond = letters.of("\U00020000x\U0001f600y")
    assert 0xE000 <= beyond[0] < 0xE000 + 6400 and beyond[1:].tolist() == [120, 32, 121, 32]
    keys, sizes = letters.sequences([None, "ab", "", "c"])
    assert sizes.tolist() == [0, 3, 0, 2]
    assert [[int(k) >> s & 0xFFFF for s in (48, 32, 16, 0)] for k in keys] == [[32, 32, 32, 97], [32, 32, 97, 98], [32, 97, 98, 32], [32, 32, 32, 99], [32, 32, 99, 32]]


def test_long_text_is_scored_whole(spark, texts):
    models = languages.fit(with_lang(spark, texts))
    text = some_text(random.Random(1), "x", 400) + " " + some_text(random.Random(2), "y", 40_000)
    row = spark.createDataFrame([(text,)], "text string").select(languages.predict("text", models).alias("p")).first().p
    assert row.lang == "y"


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.QUERIES["op11_language_id"](spark, folder).toPandas()  # noqa: F841
    rows = duckdb.sql(f"SELECT doc_id, held_out, lang_pred, lang, score FROM scored JOIN '{folder}/documents.parquet' USING (doc_id)").fetchall()
    import zlib

    assert len(rows) == 1000 and all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h, *_ in rows)
    assert np.mean([p == y for _, h, p, y, _ in rows if h]) >= 0.97
    assert all(0 <= s <= 1 for *_, s in rows)


def test_slots_and_counts_merge(texts):
    import pandas as pd

    batch = pd.DataFrame({"lang": [y for *_, y in texts], "calibrating": False, "text": [t for _, t, _ in texts]})
    parts = [batch.iloc[i::20] for i in range(20)]
    got, want = defaultdict(int), Counter()
    for part in languages._counted(iter(parts)):
        for lang, gram, n in zip(part["lang"], part["gram"], part["n"]):
            got[lang, gram] += n
    letters = languages.Letters()
    for _, t, y in texts:
        want.update((y, int(k)) for k in letters.sequences([t])[0].view(np.int64))
    assert got == want
    assert max(languages.slots(np.arange(1000, dtype=np.uint64), 3)) < 1 << languages.SLOT_BITS
