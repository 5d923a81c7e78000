"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Every passage of every document is a query. The index is small and fixed (test items), the
documents are what grows, so the index travels to the documents. Scores are shares of the score
an item gives its own text, hence one threshold for short and long items.

1. A passage meets the highest impacts of each block of items; it goes on when some block
   could reach the threshold.
2. WAND walks the postings of the passage's words: cursors in order of item, pivot where the sum of
   maxima reaches the threshold, blocks whose maxima cannot reach it are jumped over.
3. Retrieved items are verified: the words of the question and of the answer that lie in runs
   of words shared with the passage.
"""

from __future__ import annotations

import math
import re
import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K1, B = 1.2, 0.75
#: Items in a block of the index.
BLOCK = 8
#: Items in one index, about; more items are searched part by part, one part on the driver at a time.
ITEMS = 4096
#: Words in a shared run that counts, for questions and for answers.
QUESTION_RUN, ANSWER_RUN = 5, 3


class Index:
    """Postings of test items with the highest impact of each term, overall and by block.

    ``counted`` has the number of all items, their mean length, and how many hold each term, where ``items`` is a
    part of them; else these are counted here.
    """

    def __init__(self, items: list[tuple[int, str]], counted: tuple[int, float, dict[bytes, int]] | None = None):
        found = [(i, words_of(t), t) for i, t in items]
        found = sorted((x for x in found if x[1]), key=lambda x: (x[0], x[2]))
        self.items = [i for i, _, _ in found]
        self.parts = [_parts(t) for _, _, t in found]
        self.longest = max((len(w) for _, w, _ in found), default=0)
        tallies = [Counter(w) for _, w, _ in found]
        here = Counter(t for tally in tallies for t in tally)
        many, mean, held = counted or (len(found), sum(len(w) for _, w, _ in found) / max(1, len(found)), here)
        self.terms = {t: k for k, t in enumerate(sorted(here))}
        idf = {t: math.log(1 + (many - held[t] + 0.5) / (held[t] + 0.5)) for t in here}
        self.postings: list[tuple[list[int], list[float]]] = [([], []) for _ in self.terms]
        self.blocks = -(-len(found) // BLOCK)
        self.block_max = np.zeros((len(self.terms), self.blocks), np.float32)
        for at, ((_, words, _), tally) in enumerate(zip(found, tallies)):
            damp = K1 * (1 - B + B * len(words) / mean)
            impacts = {t: idf[t] * n * (K1 + 1) / (n + damp) for t, n in tally.items()}
            own = sum(impacts.values())
            for t, impact in impacts.items():
                k = self.terms[t]
                self.postings[k][0].append(at)
                self.postings[k][1].append(impact / own)
                self.block_max[k, at // BLOCK] = max(self.block_max[k, at // BLOCK], np.float32(impact / own * (1 + 1e-6)))
        self.term_max = [max(x) for _, x in self.postings]

    def retrieve(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items whose score for a passage with these terms is at least ``least``."""
        cursors = [[self.postings[k][0][0], k, 0] for k in terms]
        out = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, k, _) in enumerate(cursors):
                bound += self.term_max[k]
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                return out
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(float(self.block_max[k, block]) for _, k, _ in cursors[: pivot + 1]) < least:
                # No item of this block up to the next cursor can reach the threshold.
                beyond = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    beyond = min(beyond, cursors[pivot + 1][0])
                self._advance(cursors, pivot + 1, max(beyond, item + 1))
            elif cursors[0][0] == item:
                score = sum(self.postings[k][1][at] for i, k, at in cursors[: pivot + 1] if i == item)
                if score >= least:
                    out.append((item, score))
                self._advance(cursors, pivot + 1, item + 1)
            else:
                self._advance(cursors, pivot, item)
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def _advance(self, cursors: list[list[int]], n: int, item: int) -> None:
        for c in cursors[:n]:
            if c[0] < item:
                items = self.postings[c[1]][0]
                c[2] = bisect_left(items, item, c[2])
                c[0] = items[c[2]] if c[2] < len(items) else -1

    def passages(self, words: list[bytes], least: float) -> Iterator[tuple[int, int, list[tuple[int, float]]]]:
        """``start, end, items`` of the passages that retrieve any item.

        A passage is two neighbouring cells, each as long as the longest item, so that an item
        lies within one passage wherever it starts.
        """
        if not self.items:
            return
        cell = max(16, self.longest)
        ids = np.fromiter(map(self.terms.get, words, repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return
        codes = np.unique(at // cell * len(self.terms) + ids[at])
        cells, terms = np.divmod(codes, len(self.terms))
        firsts = np.flatnonzero(np.diff(cells, prepend=-1))
        best = np.zeros((len(words) // cell + 2, self.blocks), np.float32)
        best[cells[firsts]] = np.add.reduceat(self.block_max[terms], firsts, axis=0)
        for p in np.flatnonzero(((best[:-1] + best[1:]) >= least * (1 - 1e-5)).any(axis=1)):
            low, high = np.searchsorted(cells, (p, p + 2))
            got = self.retrieve(np.unique(terms[low:high]).tolist(), least)
            if got:
                yield int(p) * cell, min(len(words), int(p + 2) * cell), got


def _parts(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item: all sentences but the last, and the last.

    A single sentence is cut in the middle.
    """
    sentences = [s for s in re.split(r"(?<=[.?!])\s+|\n+", text) if s.strip()]
    if len(sentences) > 1:
        return words_of(" ".join(sentences[:-1])), words_of(sentences[-1])
    words = words_of(text)
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def _overlap(part: list[bytes], passage: list[bytes], run: int) -> float:
    """Share of the words of ``part`` that lie in runs of ``run`` words also in ``passage``."""
    if not part:
        return 1.0
    run = min(run, len(part))
    there = {tuple(passage[i : i + run]) for i in range(len(passage) - run + 1)}
    covered = np.zeros(len(part), bool)
    for i in range(len(part) - run + 1):
        if tuple(part[i : i + run]) in there:
            covered[i : i + run] = True
    return float(covered.mean())


def _indexes(items: DataFrame, item_col: str, item_text_col: str) -> Iterator[Index]:
    """Indexes of all items, about ``ITEMS`` in each; frequencies and the mean length are those of all."""
    known = items.select(F.col(item_col).cast("bigint").alias("i"), F.col(item_text_col).alias("t")).filter("i is not null and t is not null")
    known = stored(known.distinct(), "test-items")
    parts = max(1, -(-known.count() // ITEMS))
    if parts == 1:
        yield Index([(r.i, r.t) for r in known.collect()])
        return

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = [words_of(t) for t in batch["t"]]
            yield pd.DataFrame({"part": batch["part"], "words": [len(w) for w in each], "terms": [sorted(set(w)) for w in each]})

    known = known.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(parts)))
    terms = stored(known.select("part", "t").mapInPandas(counted, "part bigint, words bigint, terms array<binary>").filter("words > 0"), "item-terms")
    many, words = terms.agg(F.count("*"), F.sum("words")).first()
    each = terms.select("part", F.explode("terms").alias("term"))
    held = stored(each.groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    for part in range(parts):
        # The items of one part and the terms they hold: about ITEMS rows, and their words.
        mine = each.filter(F.col("part") == part).select("term").distinct().join(held, "term").collect()
        counts = {bytes(r.term): r.n for r in mine}
        yield Index([(r.i, r.t) for r in known.filter(F.col("part") == part).collect()], (many, words / many, counts) if many else None)


def _found(index: Index, text: str | None, least: float, overlap: float, first: bool = False) -> dict[int, tuple[float, float, float, int]]:
    """``score, question_overlap, answer_overlap, passages`` of each item of a text; of any one, with ``first``."""
    words, found = words_of(text), {}
    for start, end, got in index.passages(words, least):
        for at, score in got:
            question, answer = index.parts[at]
            q = _overlap(question, words[start:end], QUESTION_RUN)
            a = _overlap(answer, words[start:end], ANSWER_RUN)
            if q >= overlap and a >= overlap:
                key = index.items[at]
                was = found.get(key, (0.0, 0.0, 0.0, 0))
                found[key] = (*max(was[:3], (score, q, a)), was[3] + 1)
                if first:
                    return found
    return found


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    least: float = 0.7, overlap: float = 0.5,
) -> DataFrame:
    """``id, item, score, question_overlap, answer_overlap, passages`` for each item found in a document.

    ``score`` is the best of its passages as a share of the item's score for itself. An item
    counts when ``score`` reaches ``least`` and both overlaps reach ``overlap`` in one passage.

    Items that are null, empty or without words are never found; items of equal text are found
    together; a repeated item row gives one result. Documents that are null or empty give no rows;
    rows that repeat a document give theirs again. Ids may be null. Other columns are not looked
    at. No items or no documents: an empty result. Scores are the same however many parts the items are searched in;
    with several, what each part finds is stored before the next one is built.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    out = None

    def search(index: Index):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [(k, key, *v) for k, t in enumerate(batch["text"]) for key, v in _found(index, t, least, overlap).items()]
                found = pd.DataFrame(rows, columns=["at", "item", "score", "question_overlap", "answer_overlap", "passages"])
                yield found.assign(id=batch["id"].to_numpy()[found["at"].to_numpy(int)]).drop(columns="at")

        return run

    schema = "id string, item bigint, score double, question_overlap double, answer_overlap double, passages bigint"
    texts = texts.withColumn("id", F.col("id").cast("string"))  # keeps every digit beside nulls
    for index in _indexes(items, item_col, item_text_col):
        got = texts.mapInPandas(search(index), schema)
        out = got if out is None else stored(out, "leaks").union(stored(got, "leaks"))
    return out.select(
        F.col("id").cast("bigint").alias(id_col), F.col("item").alias(item_col), "score", "question_overlap", "answer_overlap", "passages"
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.7, overlap: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` in which ``leaks`` finds nothing, with all their columns and where they are: nothing is shuffled.

    Each row goes by its own text, whatever its id; null and empty texts stay, as does every row where there are no items.
    """
    at = docs.columns.index(text_col)

    def kept(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not (t and _found(index, t, least, overlap, first=True)) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for index in _indexes(items, item_col, item_text_col):
        docs = docs.mapInArrow(kept(index), docs.schema)
    return docs
