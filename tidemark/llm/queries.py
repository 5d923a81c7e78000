"""The registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate, languages, licences, lines, minhash, negatives, neighbours, packing, quality, runs, suffixes, toxicity, warc,
)
from tidemark.llm.common import small_batches, table
from tidemark.session import shared_folder

QUERIES, SQL = {}, {}

#: Words in SQL are what lies between the six ASCII blanks, A-Z in lower case.
SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x20\\x09-\\x0D]+')"
)


def query(sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql.strip()
        return run

    return register


def fold(key: str, parts: int) -> Column:
    """Part of a row: crc32 of its id as text, modulo ``parts``; null ids are in no part."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


def packed(docs: DataFrame) -> DataFrame:
    made = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    digests = made.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, order=("doc_id", "piece", "start", "ids_crc32"))


def _canonical_sql(text: str) -> str:
    # RE2 has no look-behind; "(c)" is written out.
    out = rf"regexp_replace(lower({text}), '(?m)^[^\p{{L}}\p{{N}}\n]*(?:copyright\b|©|\(c\))[^\n]*$', '', 'g')"
    out = rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
    for one, other in licences.EQUIVALENT:
        out = f"replace({out}, '{one}', '{other}')"
    return f"trim({out})"


_KNOWN_SQL = ", ".join("('" + i + "', '" + t.replace("'", "''") + "')" for i, t in licences.KNOWN)


@query(f"""
WITH k AS (SELECT sha256({_canonical_sql('t')}) AS digest, min(i) AS license_id FROM (VALUES {_KNOWN_SQL}) v(i, t) GROUP BY 1),
d AS (SELECT doc_id, text, {_canonical_sql('text')} AS c FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
n AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT doc_id, sha256({_canonical_sql('line')}) AS digest FROM l) JOIN k USING (digest) GROUP BY 1),
w AS (SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest FROM d)
SELECT doc_id, digest, license_id, notices FROM w LEFT JOIN k USING (digest) LEFT JOIN n USING (doc_id)
""")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_digests(spark))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query()
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    trees = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return judged(docs.select("doc_id", quality.score("text", trees).alias("score")), held_out)


@query("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
spots AS (SELECT doc_id, x, unnest(range(1, len(x) - 1)) AS i FROM l),
w AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x[i], x[i + 1], x[i + 2] ORDER BY doc_id, i) AS nth FROM spots),
gone AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM w WHERE nth > 1),
each AS (SELECT doc_id, unnest(x) AS line, unnest(range(1, len(x) + 1)) AS i FROM l),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(x)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return judged(docs.select("doc_id", toxicity.score("text", model).alias("score")), held_out)


@query(f"""
WITH RECURSIVE words AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS common
    FROM one x JOIN one y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  WHERE 100 * common >= 85 * (na + nb - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) USING (doc_id)
""")
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query("""
WITH d AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS x, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, n AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 1 + 10 * (j // 8), 10))::BIGINT >> (35 - 5 * (j % 8))) & 31)::INT, 1) FOR j IN range(32)], '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    models = languages.fit(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), languages.predict("text", models).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected")


def with_repetitions(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, of which one in ten repeats a stretch of its own words to the end, as ids and lengths have it."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(hashed / 10).alias("g"), some.alias("words")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repetitions(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("top"), F.array_join(lines, "").alias("lines"), "collapsed")
    return found.select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("bigint").alias("label"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)
