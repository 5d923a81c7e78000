"""Line dedup by overlapping windows of consecutive lines.

Each window of three lines is hashed; the first document that holds a window keeps it, and later
documents, or later places in the same document, lose the lines it covers. Lines covered by
several windows are merged. A document sends each of its windows once, so the shuffle holds hashes
and ids, not texts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, fresh, mixed, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _window_hashes(known: WordHashes, text: str, size: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lines, and two independent 64-bit hashes for each window."""
    lines = text.split("\n")
    n = len(lines) - size + 1
    if n < 1:
        return lines, np.empty(0, np.int64), np.empty(0, np.int64)
    each = known.of([x.encode("utf-8", "surrogatepass") for x in lines])
    one, two = np.zeros(n, np.uint64), np.full(n, 0x632BE59BD9B4E019, np.uint64)
    for i in range(size):
        one = mixed((one + each[i : n + i]) * np.uint64(0x9E3779B97F4A7C15))
        two = mixed((two ^ each[i : n + i]) * np.uint64(0xD6E8FEB86659FD93))
    return lines, one.view(np.int64), two.view(np.int64)


def _later(first: set[int], hashes: np.ndarray) -> np.ndarray:
    """Windows to remove: those first seen in an earlier document, and repeats in this one."""
    later = np.ones(len(hashes), bool)
    later[np.unique(hashes, return_index=True)[1]] = False
    return later | np.isin(hashes, np.fromiter(first, np.int64, len(first))) if first else later


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text_col``; adds ``n_lines, n_removed``.

    Lines end at ``\\n`` and are compared as they are. A line goes when it lies in a window of
    ``size`` lines that also starts in a document with a smaller id, or earlier in its own.

    Texts of fewer lines stay as they are, as do empty ones; null stays null with 0 lines. Rows
    with a null id lose only what they repeat themselves and take nothing from others. Rows that
    repeat an id take nothing from each other. Columns named ``n_lines`` or ``n_removed`` are
    replaced, all others are kept.
    """

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            ids, ones, twos = [], [], []
            for i, text in zip(batch["id"], batch["text"]):
                _, one, two = _window_hashes(known, text, size)
                at = np.unique(one, return_index=True)[1]
                ones.append(one[at])
                twos.append(two[at])
                ids.append(np.full(len(at), i, np.int64))
            if ids:
                yield pd.DataFrame({"id": np.concatenate(ids), "one": np.concatenate(ones), "two": np.concatenate(twos)})

    @F.pandas_udf("text string, n_lines bigint, n_removed bigint")
    def cut(texts: pd.Series, later: pd.Series) -> pd.DataFrame:
        known, out = WordHashes(), []
        for text, first in zip(texts, later):
            if text is None:
                out.append((None, 0, 0))
                continue
            lines, one, _ = _window_hashes(known, text, size)
            at = np.flatnonzero(_later(set() if first is None else set(first), one))
            if not len(at):
                out.append((text, len(lines), 0))
                continue
            covered = np.zeros(len(lines) + 1, np.int64)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + size, -1)
            keep = np.cumsum(covered[:-1]) == 0
            kept = "\n".join(x for x, k in zip(lines, keep) if k)
            out.append((kept, len(lines), len(lines) - int(keep.sum())))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])

    full = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    seen = stored(full.mapInPandas(windows, "id bigint, one bigint, two bigint"), "line-windows")
    repeated = stored(
        seen.groupBy("one", "two").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last"),
        "line-repeats",
    )
    key, gone, done = (fresh(docs, x) for x in ("_id", "_later", "_cut"))
    later = seen.join(repeated, ["one", "two"]).filter("id > first").groupBy(F.col("id").alias(key)).agg(F.collect_set("one").alias(gone))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(id_col).cast("bigint").alias(key)).join(later, key, "left")
    rows = rows.withColumn(done, cut(F.col(text_col), F.col(gone)))
    return rows.select(
        *[F.col(f"{done}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in names], F.col(f"{done}.n_lines"), F.col(f"{done}.n_removed")
    )
