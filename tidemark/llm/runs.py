"""Periodic runs of words: stretches that repeat a shorter sequence at least twice.

A batch of texts becomes one sequence of word numbers, in which no two texts share a number and each
text ends with a number of its own, so that nothing matches across texts. Doubling sorts its suffixes and names
all blocks of 1, 2, 4 ... words on the way. A run of period ``p`` holds a block of dyadic length ``b``,
aligned to half its length, that occurs again ``p`` words on, with ``p`` within three block lengths. Those
occurrences are asked of a wavelet tree over the suffix array: the block's interval there, and the window of
positions next to it. Within a window of ``b`` starts they form an arithmetic progression, so its first two members and
their number give every candidate period. Candidates are extended to both sides by the block names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Least length of a run, in words.
LEAST = 12
#: Words that are searched together; a longer text is searched alone.
WORDS_AT_ONCE = 200_000


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def block_names(sequence: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, 2 ...: a number for each position, equal where the next ``2 ** k`` members are equal.

    The last array is the rank of each suffix. Every suffix must differ from all others within the sequence, as it
    does where each text ends with a member of its own.
    """
    n = len(sequence)
    order = np.argsort(sequence, kind="stable")
    new = np.ones(n, bool)
    new[1:] = sequence[order[1:]] != sequence[order[:-1]]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    names, width = [rank], 1
    open_ = order[np.repeat(np.diff(np.append(starts, n)) > 1, np.diff(np.append(starts, n)))]
    while len(open_):
        first, second = rank[open_], rank[open_ + width]
        at = np.argsort(first * (n + 1) + second, kind="stable")
        open_, first, second = open_[at], first[at], second[at]
        group, new = np.ones(len(at), bool), np.ones(len(at), bool)
        group[1:] = first[1:] != first[:-1]
        new[1:] = group[1:] | (second[1:] != second[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        begin = np.maximum.accumulate(np.where(group, np.arange(len(at)), 0))
        rank = rank.copy()
        rank[open_] = first + np.repeat(starts, sizes) - begin
        names.append(rank)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        width *= 2
    return names


class WaveletTree:
    """Counts and order statistics of the values in a range, for many ranges at once; values are below ``2 ** bits - 1``."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels, self.most = [], (1 << bits) - 1
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros))
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in ``[low, high)`` are smaller than ``bound``."""
        count, bound = np.zeros(len(low), np.int64), np.minimum(bound, self.most)
        for bit, zeros in self.levels:
            a, b, one = zeros[low], zeros[high], (bound >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The ``nth`` smallest value in ``[low, high)``, from 0."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[low], zeros[high]
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return value


def _progressions(tree: WaveletTree, low: np.ndarray, high: np.ndarray, block: np.ndarray, nearest: int, furthest: int, size: int):
    """``block, distance`` of each other place of a block that lies ``nearest`` to ``furthest`` words further on."""
    for start in range(nearest, furthest + 1, size):
        stop = min(start + size - 1, furthest)
        before = tree.below(low, high, block + start)
        found = tree.below(low, high, block + stop + 1) - before
        some = np.flatnonzero(found)
        if not len(some):
            continue
        a, b, j, n, nth = low[some], high[some], block[some], found[some], before[some]
        first = tree.smallest(a, b, nth) - j
        step = np.zeros(len(some), np.int64)
        more = n > 1
        step[more] = tree.smallest(a[more], b[more], nth[more] + 1) - j[more] - first[more]
        which = np.repeat(np.arange(len(some)), n)
        place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield j[which], first[which] + place * step[which]


def _extended(names: list[np.ndarray], block: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around each block in which members that far apart are equal."""
    left, right = block.copy(), block + distance
    for k in range(len(names) - 2, -1, -1):
        inside = np.flatnonzero(left >= 1 << k)
        same = inside[names[k][left[inside] - (1 << k)] == names[k][left[inside] + distance[inside] - (1 << k)]]
        left[same] -= 1 << k
        same = names[k][right - distance] == names[k][right]
        right[same] += 1 << k
    return left, right


def find_runs(sequence: np.ndarray, least: int = LEAST) -> np.ndarray:
    """``start, end, period`` of all maximal runs of at least ``least`` members and two periods, by start and period.

    ``least`` is at least 9. Members of different texts differ and each text ends with a member of its own.
    """
    names = block_names(sequence)
    found = [np.empty((0, 3), np.int64)]
    if len(names) > 3:  # else no four members occur twice
        ranks = names[-1]
        order = np.empty(len(ranks), np.int64)
        order[ranks] = np.arange(len(ranks))
        # Only suffixes that share four members with another can matter.
        groups = names[2][order]
        alone = np.ones(len(order) + 1, bool)
        alone[1:-1] = groups[1:] != groups[:-1]
        order = order[~(alone[:-1] & alone[1:])]
        tree = WaveletTree(order, (len(sequence) + 1).bit_length())
        for k in range(2, len(names) - 1):
            size = 1 << k
            groups = names[k][order]
            starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            sizes = np.diff(np.append(starts, len(order)))
            low = np.repeat(starts, sizes)
            asked = np.flatnonzero((order % (size // 2) == 0) & np.repeat(sizes > 1, sizes))
            if not len(asked):
                continue
            # A block aligned to half its size fits into any 1.5 * size - 1 members: of a run less one period.
            nearest = 1 if k == 2 else size + size // 2 - 1
            high, low = (low + np.repeat(sizes, sizes))[asked], low[asked]
            for block, distance in _progressions(tree, low, high, order[asked], nearest, 3 * size - 2, size):
                left, right = _extended(names, block, distance)
                long = right - left >= np.maximum(least, 2 * distance)
                found.append(np.unique(np.stack((left[long], right[long], distance[long]), axis=1), axis=0))
    out = np.unique(np.concatenate(found), axis=0)
    # A stretch found with several periods has the smallest of them; the others are multiples.
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:, 0] != out[:-1, 0]) | (out[1:, 1] != out[:-1, 1])
    out = out[keep]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _searched(texts: list[list[bytes]], least: int) -> Iterator[tuple[int, np.ndarray]]:
    """``text, runs`` of those texts that hold runs, with places counted from the start of the text."""
    lengths = np.array([len(x) for x in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    numbers, sequence = _Numbers(), np.empty(starts[-1], np.int64)
    for i, words in enumerate(texts):
        part = sequence[starts[i] : starts[i + 1]]
        part[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        part[-1] = -1
    sequence += np.repeat(np.arange(len(texts)), lengths + 1) * (len(numbers) + 1) + 1
    found = find_runs(sequence, least)
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    for i in np.unique(owner):
        mine = found[owner == i]
        mine[:, :2] -= starts[i]
        yield int(i), mine


def _judged(texts: pd.Series, least: int) -> pd.DataFrame:
    split = [[] if t is None else t.encode("utf-8", "surrogatepass").split() for t in texts]
    empty = np.empty(0, np.int64)
    starts, lengths, periods = ([empty] * len(split) for _ in range(3))
    kept = [b" ".join(words).decode("utf-8", "surrogatepass") for words in split]
    low = 0
    while low < len(split):
        high, words = low + 1, len(split[low])
        while high < len(split) and words + len(split[high]) <= WORDS_AT_ONCE:
            words += len(split[high])
            high += 1
        for i, mine in _searched(split[low:high], least):
            starts[low + i], lengths[low + i], periods[low + i] = mine[:, 0], mine[:, 1] - mine[:, 0], mine[:, 2]
            covered = np.zeros(len(split[low + i]) + 1, np.int64)
            np.add.at(covered, mine[:, 0] + mine[:, 2], 1)
            np.add.at(covered, mine[:, 1], -1)
            stay = (np.cumsum(covered[:-1]) == 0).tolist()
            kept[low + i] = b" ".join(compress(split[low + i], stay)).decode("utf-8", "surrogatepass")
        low = high
    n_words = [len(words) for words in split]
    return pd.DataFrame({"n_words": n_words, "starts": starts, "lengths": lengths, "periods": periods, "collapsed": kept})


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are what lies between the six ASCII blanks, compared as they are. ``runs`` lists ``start, length, period``
    (in words, from 0) of every stretch with that smallest period, at least ``least`` words and two periods long,
    that no neighbouring word extends; by start, then period. ``collapsed`` is the text with one period left of each run:
    its words less those that lie in a run after its first period, joined by one blank.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Rows are judged one by one,
    so repeated rows and ids get equal results, and an empty table gives none. Columns named ``n_words``,
    ``runs`` or ``collapsed`` are replaced, all others are kept. A text is held in the memory of one task.
    """
    if least < 9:
        raise ValueError("runs of fewer than nine words are not found by blocks of four")

    @F.pandas_udf("n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return _judged(texts, least)

    names = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    made = "judged"
    while made in names:
        made += "_"
    rows = docs.select(*[F.col(f"`{c}`") for c in names], judge(F.col(f"`{text_col}`")).alias(made))
    runs = F.arrays_zip(F.col(f"{made}.starts").alias("start"), F.col(f"{made}.lengths").alias("length"), F.col(f"{made}.periods").alias("period"))
    fields = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return rows.select(*[F.col(f"`{c}`") for c in names], F.col(f"{made}.n_words"), runs.cast(fields).alias("runs"), F.col(f"{made}.collapsed"))
