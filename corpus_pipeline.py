"""From documents to packed training sequences: five stages, each on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, lines, minhash, quality
from tidemark.llm.common import fresh, may_be_among, small_batches, stored, table
from tidemark.llm.queries import fold, packed

#: Documents that score lower are rejected.
LEAST_QUALITY = 0.3


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Rows go by their text alone, a null one counts as empty: repeated rows and rows without an id are judged like others.
    """
    small_batches(spark)
    trees = quality.fit(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    name = fresh(docs, "_score")
    scored = docs.withColumn(name, quality.score("text", trees))
    return scored.filter(F.col(name) >= LEAST_QUALITY).drop(name)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the windows of lines that came before; a document may end up empty, but stays.

    Null texts stay null. Rows without an id lose only what they repeat themselves.
    """
    small_batches(spark)
    cut = lines.dedup_lines(docs).drop("n_lines", "n_removed")
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Of rows that repeat an id and its text one stays; an id with several texts goes only when none of
    them is kept. Rows without an id stay. Only rows whose id may be gone or repeated are shuffled, the others stay where they are.
    """
    small_batches(spark)
    judged = minhash.near_duplicates(docs, size=5, percent=80).filter("doc_id is not null")
    judged = judged.groupBy("doc_id").agg(F.max("kept").alias("any"), F.count("*").alias("n")).filter("n > 1 or not any")
    judged = stored(judged, "suspects", release=True)
    name = fresh(docs, "_suspect")
    marked = docs.withColumn(name, may_be_among(F.col("doc_id"), judged.select("doc_id")))
    moved = marked.filter(F.col(name)).drop(name).join(judged.filter("not any").select("doc_id"), "doc_id", "left_anti")
    text = fresh(docs, "_digest")
    moved = moved.withColumn(text, F.sha2("text", 256)).dropDuplicates(["doc_id", text]).select(*docs.columns)
    return marked.filter(~F.col(name)).drop(name).union(moved)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whatever their ids: rows go by their text, which is all that decides.

    Null and empty texts hold none and stay.
    """
    small_batches(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokens and their places in sequences; null and empty texts are one piece, the end mark."""
    small_batches(spark)
    return packed(docs)


STAGES = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("benchmarks", without_benchmarks),
    ("packing", sequences),
]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", release=True)
    return STAGES[-1][1](spark, docs, sf_dir)
