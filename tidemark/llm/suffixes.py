"""Repeated passages removed byte by byte, decided by suffix arrays.

1. Every string of ``length`` bytes holds an anchor: the ``GRAM`` bytes with the smallest hash in it.
   Equal strings choose the same anchor, so documents that share a string share an anchor.
2. Anchors of several documents are found by their hashes. Around each lies its context: all strings
   of ``length`` bytes that hold it.
3. Names (hashes) of contexts go before their bytes: equal contexts are found by name, and all but the
   first document that has one remove it whole. Only the first document sends the bytes, and only where
   several different contexts have the anchor.
4. Different contexts of one anchor meet in one task; a suffix array of what they may share, made by
   linear grouping, brings equal strings together, and each string gets the smallest id that has it.
   Where an anchor has very many contexts, they are first split by their strings (see ``_crowded``).
5. Documents look up their contexts and remove what an earlier document also has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of an anchor.
GRAM = 24
#: Bytes of contexts that one group of a task holds.
GROUP_BYTES = 200_000
#: Bytes of texts that are hashed together.
CACHED_BYTES = 1 << 15
#: Contexts of one anchor that a suffix array takes; those of more crowded ones are split by their strings,
#: into so many parts at a time.
CROWD, SPLIT = 5_000, 4


def suffix_array(symbols: list[int]) -> list[int]:
    """Order of all suffixes of ``symbols`` (numbers above 0), by linear grouping.

    Suffixes are grouped by a prefix that grows to their Lyndon prefix. Groups are taken from the
    largest down: each tells the nearest earlier suffix of a smaller group (its previous-smaller
    pointer) that it continues that suffix's prefix, which moves those suffixes to new groups just
    above their old ones. When all groups are done, suffixes are placed from the smallest up: a
    placed suffix places those that lead to it along the pointers.
    """
    text = [*symbols, 0]
    n = len(text)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        if c in by_symbol:
            by_symbol[c].append(i)
        else:
            by_symbol[c] = [i]
    # Of the place before the first (-1, the last entry): a group below all others.
    group = [0] * n + [-1]
    members: list[list[int]] = [[]] * n
    starts_at, ends_at = [0] * (n + 1), [0] * (n + 1)
    at = 0
    for c in sorted(by_symbol):
        mine = by_symbol[c]
        for i in mine:
            group[i] = at
        members[at] = mine
        end = at + len(mine)
        starts_at[end], ends_at[at] = at, end
        at = end
    previous = [-1] * n
    end = n
    while end > 0:
        start = starts_at[end]
        if end - start == 1:
            # One suffix points to one at most, which moves to the top of its group.
            for i in members[start]:
                if group[i] == start:
                    p = i - 1
                    while group[p] >= start:
                        p = previous[p]
                    previous[i] = p
                    if p >= 0:
                        old = group[p]
                        top = ends_at[old]
                        new = top - 1
                        if new != old:
                            group[p] = new
                            members[new] = [p]
                            starts_at[top], ends_at[new] = new, top
                            starts_at[new], ends_at[old] = old, new
            end = start
            continue
        pointed: dict[int, int] = {}
        for i in members[start]:
            if group[i] != start:
                continue
            p = i - 1
            while group[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                pointed[p] = pointed[p] + 1 if p in pointed else 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, k in pointed.items():
            key = (-k, group[p])
            if key in moves:
                moves[key].append(p)
            else:
                moves[key] = [p]
        for key in sorted(moves) if len(moves) > 1 else moves:
            old, moved = key[1], moves[key]
            top = ends_at[old]
            new = top - len(moved)
            if new == old:
                continue  # the whole group goes on
            for p in moved:
                group[p] = new
            moved.sort()
            members[new] = moved
            starts_at[top], ends_at[new] = new, top
            starts_at[new], ends_at[old] = old, new
        end = start
    out, free, placed = [0] * n, list(range(n)), [False] * n
    # The last place is placed first; it also ends the way before the first.
    out[0], placed[n - 1] = n - 1, True
    for i in range(n):
        p = out[i] - 1
        while not placed[p]:
            s = group[p]
            k = free[s]
            out[k], free[s], placed[p] = p, k + 1, True
            p = previous[p]
    return out[1:]


def _rolled(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` symbols, put together from runs of powers of two."""
    factors, runs, n = [np.full(1, 0x9E3779B97F4A7C15, np.uint64)], [symbols], 1
    while n * 2 <= size:
        one = runs[-1]
        runs.append(one[:-n] * factors[-1] + one[n:])
        factors.append(factors[-1] * factors[-1])
        n *= 2
    out, done = runs[-1], n
    for k in range(len(runs) - 2, -1, -1):
        if done + (1 << k) <= size:
            tail = runs[k][done:]
            out = out[: len(tail)] * factors[k] + tail
            done += 1 << k
    return out[: len(symbols) - size + 1]


def _over(values: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` neighbours."""
    n = 1
    while n * 2 <= width:
        values = f(values[:-n], values[n:])
        n *= 2
    return f(values[: len(values) - (width - n)], values[width - n :]) if width > n else values


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, place and hash of each anchor, and the name of its context; none in texts shorter than ``length``.

    A name is a hash of the bytes around an anchor and of where the text begins or ends in them. Texts are
    hashed together, as many as fit into a cache.
    """
    found, low, size = [], 0, 0
    for high, raw in enumerate(texts, 1):
        size += len(raw)
        if size >= CACHED_BYTES or high == len(texts):
            owner, *more = _anchors(texts[low:high], length)
            found.append((owner + low, *more))
            low, size = high, 0
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(map(np.concatenate, zip(*found)))


def _anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    side = length - GRAM
    width = side + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 2 * side) - sizes - side
    # Between texts and at both ends are zeros, which no byte of a text is.
    gap = bytes(2 * side)
    padded = np.frombuffer(gap[:side] + gap.join(texts) + gap[:side], np.uint8).astype(np.uint64)
    padded += np.uint64(1)
    padded[:side] = 0
    padded[((starts + sizes)[:, None] + np.arange(2 * side)).ravel()[: -side or None]] = 0
    grams = _rolled(padded, GRAM)
    # Anchors are chosen by 32 bits of a hash; where these are equal, all are taken.
    rank = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _over(rank, width, np.minimum)
    # Strings that lie within one text.
    able = sizes >= length
    inside = np.zeros(len(least) + 1, np.int8)
    inside[starts[able]] = 1
    inside[starts[able] + sizes[able] - length + 1] = -1
    least *= np.cumsum(inside[:-1], dtype=np.int8).astype(np.uint32)
    edge = np.zeros(width - 1, np.uint32)
    at = np.flatnonzero(_over(np.concatenate((edge, least, edge)), width, np.maximum) == rank)
    # The runs of GRAM bytes that a context is covered by.
    context = np.zeros(len(at), np.uint64)
    for low in (*range(0, 2 * side, GRAM), 2 * side):
        context = context * np.uint64(0xD6E8FEB86659FD93) + mixed(grams[at - side + low])
    owner = np.searchsorted(starts, at, "right") - 1
    return owner, at - starts[owner], mixed(grams[at]), mixed(context)


def _of(owner: np.ndarray, names: np.ndarray) -> np.ndarray:
    """One number for a name in a text of the batch."""
    return names ^ mixed(owner.astype(np.uint64) + np.uint64(1))


def _listed(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the lists, and their entries."""
    flat = [np.asarray(x, np.int64) for x in lists]
    owner = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
    return owner, np.concatenate([*flat, np.empty(0, np.int64)]).view(np.uint64)


def _heads(h: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: the first of each (anchor, context, document), and the first of each (anchor, context)."""
    least = np.ones(len(h), bool)
    least[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    new = least.copy()
    new[1:] |= d[1:] != d[:-1]
    return new, least


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _reach(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """For each row: how many symbols from the left on it has in common with any other row of its anchor (0 never is)."""
    order = np.lexsort((*rows.T[::-1], anchor))
    one, two = rows[order[:-1]], rows[order[1:]]
    same = (one == two) & (one > 0) & (anchor[order[:-1]] == anchor[order[1:]])[:, None]
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    out = np.zeros(len(rows), np.int64)
    out[order[:-1]] = common
    out[order[1:]] = np.maximum(out[order[1:]], common)
    return out


def _least(anchor: np.ndarray, place: np.ndarray, first: np.ndarray, contexts: list[bytes], length: int, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray]]:
    """``context's index, places`` of its strings of ``length`` bytes that a smaller id also has. Rows come by anchor (of ``gram`` bytes).

    The suffix array's text has, for each context, what it may share: as many bytes on either side of
    the anchor as it has in common with any other context. One symbol stands for the anchor and for
    the bytes next to it that all have and that every string has to hold.
    """
    side = length - gram
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    owner = np.repeat(np.arange(len(contexts)), sizes)
    column = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes - (side - place), sizes)
    rows = np.zeros((len(contexts), 2 * side + gram), np.int16)
    rows[owner, column] = np.frombuffer(b"".join(contexts), np.uint8)
    rows[owner, column] += 1
    rows = np.delete(rows, slice(side, side + gram), axis=1)
    _, group = np.unique(anchor, return_inverse=True)
    left, right = _reach(rows[:, side - 1 :: -1], group), _reach(rows[:, side:], group)
    able = np.flatnonzero(left + right >= side)
    if not len(able):
        return
    rows, group, left, right = rows[able], group[able], left[able], right[able]
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    counts = np.diff(np.append(heads, len(able)))
    leader = np.repeat(heads, counts)
    alike = (rows == rows[leader]) & (rows > 0)
    near = [np.logical_and.accumulate(x, axis=1).sum(axis=1) for x in (alike[:, side - 1 :: -1], alike[:, side:])]
    skip_left = np.repeat(np.minimum(np.minimum.reduceat(near[0], heads), side - np.maximum.reduceat(right, heads)), counts)
    skip_right = np.repeat(np.minimum(np.minimum.reduceat(near[1], heads), side - np.maximum.reduceat(left, heads)), counts)
    before, sizes = left - skip_left, left - skip_left + right - skip_right + 2
    ends = np.cumsum(sizes)
    low = 0
    while low < len(able):
        # As many anchors at a time as fit.
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + GROUP_BYTES, "right")))
        while high < len(able) and group[high] == group[high - 1]:
            high += 1
        size = sizes[low:high]
        owner = np.repeat(np.arange(low, high), size)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        low = high
        text = np.ones(len(owner), np.int64)
        at = np.flatnonzero(within < before[owner])
        text[at] = rows[owner[at], side - left[owner[at]] + within[at]] + 1
        at = np.flatnonzero(within == before[owner])
        text[at] = 300 + group[owner[at]]
        at = np.flatnonzero((within > before[owner]) & (within < sizes[owner] - 1))
        text[at] = rows[owner[at], side + skip_right[owner[at]] + within[at] - before[owner[at]] - 1] + 1
        order = np.array(suffix_array(text.tolist()), np.int64)
        # Suffixes that start with a whole string holding the anchor, in order.
        order = order[within[order] <= (left + right - side)[owner[order]]]
        reach, symbols = np.arange(side + 1), (side + 1 - skip_left - skip_right)[owner[order]]
        same = np.zeros(len(order), bool)
        for at in range(1, len(order), 20_000):
            one, two = order[at - 1 : at + 19_999], order[at : at + 20_000]
            one = one[: len(two)]
            # Past a string's end nothing is compared.
            places = np.minimum(reach, symbols[at : at + 20_000, None] - 1)
            ahead = np.minimum(one[:, None] + places, len(text) - 1)
            same[at : at + 20_000] = (text[ahead] == text[two[:, None] + places]).all(axis=1)
        heads = np.flatnonzero(~same)
        ids = first[able[owner[order]]]
        lowest = np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.append(heads, len(order))))
        later = np.sort(order[lowest < ids])
        whose = owner[later]
        where = place[able[whose]] - left[whose] + within[later]
        cuts = np.flatnonzero(np.diff(whose, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(later)]):
            yield int(able[whose[a]]), where[a:b]


def _sorted(group: pd.DataFrame, length: int, gram: int = GRAM) -> pd.DataFrame:
    """``c, id, starts`` of strings that an earlier document of the group has."""
    group = group.sort_values("anchor")
    c, first = group["c"].to_numpy(np.int64), group["first"].to_numpy(np.int64)
    shift = group["shift"].to_numpy(np.int64) if "shift" in group else np.zeros(len(group), np.int64)
    found = _least(group["anchor"].to_numpy(np.int64), group["place"].to_numpy(np.int64), first, group["context"].tolist(), length, gram)
    return pd.DataFrame([(c[k], first[k], starts + shift[k]) for k, starts in found], columns=["c", "id", "starts"])


def _bins(contexts: int, length: int) -> int:
    return max(1, contexts * 2 * length // GROUP_BYTES)


def _crowded(contexts: DataFrame, length: int) -> DataFrame:
    """``c, id, starts`` of strings that an earlier document has, for anchors with many contexts.

    A context's strings are split into ``SPLIT`` parts by how many bytes they have left of the anchor. All
    strings of a part hold more than the anchor, so contexts part ways: those that are alone with these bytes
    are done, groups of up to ``CROWD`` get a suffix array. In larger groups, contexts that are equal as far
    as the part's strings reach go by name, only the first document's are split again. A part of one string
    is settled by the names alone. So a context makes ``SPLIT`` rows in each round that it takes part in, and
    rounds are few: as many as splits make one string of all.
    """
    side = length - GRAM
    rows = contexts.select("anchor", "c", "first", F.lit(0).alias("low"), F.lit(side).alias("high"), F.lit(0).alias("shift"), "place", "context")
    right = F.octet_length("context") - F.col("place") - GRAM
    # Bytes that strings of a part have to the left of the anchor: from low to high, and as many as the text has.
    before, after = F.least("place", "high"), F.least(right, side - F.col("low"))
    held = F.substring("context", F.col("place") - F.col("low") + 1, F.col("low") + GRAM + side - F.col("high"))
    around = F.substring("context", F.col("place") - before + 1, before + GRAM + after)
    few, found, step = [], [], side + 1
    while step > 1:
        step = -(-step // SPLIT)
        parts = rows.withColumn("low", F.explode(F.sequence("low", "high", F.lit(step)))).withColumn("high", F.least("high", F.col("low") + step - 1))
        parts = parts.filter((F.col("place") >= F.col("low")) & (right >= side - F.col("high"))).select(
            "anchor", "c", "first", "low", "high", (F.col("shift") + F.col("place") - before).alias("shift"), before.alias("place"),
            around.alias("context"), F.xxhash64("anchor", "low", held).alias("part"),
        )
        groups = parts.groupBy("anchor", "part").agg(F.count("*").alias("n"), F.min("first").alias("one"), F.max("first").alias("other"))
        groups = stored(groups.filter("n > 1 and one < other").select("anchor", "part", (F.col("n") > CROWD).alias("hot")), "crowded-parts")
        parts = stored(parts.join(groups, ["anchor", "part"]), "crowded-contexts-by-part", release=True)
        hot = parts
        if step > 1:
            few.append(parts.filter("not hot"))
            hot = parts.filter("hot")
        if hot.isEmpty():
            break
        hot = hot.withColumn("name", F.xxhash64("part", "place", "context"))
        names = stored(hot.groupBy("part", "name").agg(F.min("first").alias("lowest")), "crowded-names")
        later = F.col("first") > F.col("lowest")
        starts = F.sequence("shift", F.col("shift") + F.col("place") - F.greatest("low", side - right))
        named = hot.join(names, ["part", "name"]).select(
            "anchor", "c", "first", "low", "high", "shift", "place", F.when(~later, F.col("context")).alias("context"), F.when(later, starts).alias("starts")
        )
        named = stored(named, "crowded-strings", release=True)
        found.append(named.filter("starts is not null").select("c", F.col("first").alias("id"), "starts"))
        rows = named.filter("starts is null").drop("starts")

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(anchor=group["part"], place=group["place"] - group["low"])
        return pd.concat([_sorted(some, length, length - int(wide)) for wide, some in group.groupby(group["high"] - group["low"])])

    for some in few:
        bins = some.withColumn("bin", F.pmod("part", F.lit(_bins(some.count(), length))))
        found.append(bins.groupBy("bin").applyInPandas(sort, "c bigint, id bigint, starts array<int>"))
    every = reduce(DataFrame.union, found)
    return every.groupBy("c", "id").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``id, n_bytes, n_removed, spans, kept``: texts as UTF-8 bytes less what earlier documents have.

    Each byte covered by a string of ``length`` bytes that also starts in a document with a smaller
    id goes. ``spans`` are the runs removed (start, end), ``kept`` the bytes left.

    Null is taken as empty; texts shorter than ``length`` stay whole. Rows with a null id stay whole
    and remove nothing. Rows that repeat an id remove nothing from each other. Strings never cross
    documents. Other columns are not looked at. An empty table gives an empty result.
    """
    if length < GRAM + 2:
        raise ValueError(f"length must be at least {GRAM + 2}")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    full = rows.filter(F.col("id").isNotNull() & (F.octet_length("text") >= length))
    total = full.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = max(1, total // (1 << 25))

    def scattered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Hashes of each batch by part; what several documents of the batch share is settled here."""
        for batch in batches:
            ids = batch["id"].to_numpy(np.int64)
            owner, _, h, _ = anchors([_bytes(t) for t in batch["text"]], length)
            d = ids[owner]
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))
            h, d = h[new], d[new]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
            many = np.diff(np.append(first, len(h))) > 1
            later = np.ones(len(h), bool)
            later[first] = False
            part = (h % np.uint64(parts)).astype(np.int64)
            out = []
            # The first holder of each hash goes to the hash's part, the others are known to be shared.
            settled = later.copy()
            settled[first[many]] = True
            if settled.any():
                out.append((parts + int(ids[0] % parts), h[settled].tobytes(), d[settled].tobytes(), b""))
            h, d, part = h[first], d[first], part[first]
            order = np.lexsort((d, part))
            h, d, part, many = h[order], d[order], part[order], many[order]
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(h) else []
            for low, high in zip(cuts, [*cuts[1:], len(h)]):
                out.append((int(part[low]), h[low:high].tobytes(), d[low:high].tobytes(), many[low:high].tobytes()))
            yield pd.DataFrame(out, columns=["part", "h", "d", "many"])

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        """Document and hash wherever several documents hold the hash."""
        h = np.frombuffer(b"".join(group["h"]), np.uint64)
        d = np.frombuffer(b"".join(group["d"]), np.int64)
        if group["part"].iloc[0] < parts:
            many = np.frombuffer(b"".join(group["many"]), bool)
            order = np.lexsort((d, h))
            h, d, many = h[order], d[order], many[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            last = np.append(first[1:], len(h)) - 1
            again = (d[first] != d[last]) | np.logical_or.reduceat(many, first)
            keep = np.repeat(again, last - first + 1)
            h, d = h[keep], d[keep]
        return pd.DataFrame({"id": d, "h": h.view(np.int64)})

    blobs = full.mapInPandas(scattered, "part bigint, h binary, d binary, many binary")
    pairs = blobs.groupBy("part").applyInPandas(shared, "id bigint, h bigint")
    lists = stored(pairs.groupBy("id").agg(F.collect_set("h").alias("hashes")), "shared-anchors", release=True)

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Names of the contexts of shared anchors by part; what several documents of the batch share is settled here."""
        for batch in batches:
            owner, _, h, c = anchors([_bytes(t) for t in batch["text"]], length)
            # A shared anchor is in the lists of all documents that have it.
            keep = np.isin(h, _listed(batch["hashes"])[1])
            h, c, d = h[keep], c[keep], batch["id"].to_numpy(np.int64)[owner[keep]]
            order = np.lexsort((d, h, c))
            h, c, d = h[order], c[order], d[order]
            new, least = _heads(h, c, d)
            later = new & ~least
            out = []
            for low in range(0, int(later.sum()), 1 << 16):
                some = np.flatnonzero(later)[low : low + (1 << 16)]
                out.append((parts + int(d[some[0]] % parts), b"", c[some].tobytes(), d[some].tobytes()))
            h, c, d = h[least], c[least], d[least]
            part = (c % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            h, c, d, part = h[order], c[order], d[order], part[order]
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            for low, high in zip(cuts, [*cuts[1:], len(part)]):
                out.append((int(part[low]), h[low:high].tobytes(), c[low:high].tobytes(), d[low:high].tobytes()))
            yield pd.DataFrame(out, columns=["part", "h", "c", "d"])

    def copies(group: pd.DataFrame) -> pd.DataFrame:
        """A row for each context and document; with the anchor where the document is the first."""
        c = np.frombuffer(b"".join(group["c"]), np.uint64)
        d = np.frombuffer(b"".join(group["d"]), np.int64)
        if group["part"].iloc[0] >= parts:
            anchor = pa.nulls(len(c), pa.int64())
        else:
            h = np.frombuffer(b"".join(group["h"]), np.uint64)
            order = np.lexsort((d, h, c))
            h, c, d = h[order], c[order], d[order]
            new, least = _heads(h, c, d)
            h, c, d, least = h[new], c[new], d[new], least[new]
            anchor = pa.array(h.view(np.int64), mask=~least)
        return pd.DataFrame({"id": d, "c": c.view(np.int64), "anchor": pd.Series(anchor, dtype=pd.ArrowDtype(pa.int64()))})

    blobs = full.join(lists, "id").mapInPandas(named, "part bigint, h binary, c binary, d binary")
    held = stored(blobs.groupBy("part").applyInPandas(copies, "id bigint, c bigint, anchor bigint"), "context-names", release=True)
    firsts = held.filter("anchor is not null")
    # Anchors that several contexts of several documents have, and what these documents are to send.
    several = firsts.groupBy("anchor").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    several = stored(several.filter("n > 1 and low < high").select("anchor", (F.col("n") > CROWD).alias("crowded")), "several-contexts")
    asked = firsts.join(several, "anchor").groupBy("id").agg(
        F.collect_list(F.when(~F.col("crowded"), F.col("c"))).alias("few"), F.collect_list(F.when(F.col("crowded"), F.col("c"))).alias("many")
    )
    asked = stored(asked, "asked-contexts", release=True)
    few, many = asked.agg(F.sum(F.size("few").cast("bigint")), F.sum(F.size("many").cast("bigint"))).first()

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The contexts asked for, with their bytes."""
        side = length - GRAM
        for batch in batches:
            texts = [_bytes(t) for t in batch["text"]]
            owner, at, h, c = anchors(texts, length)
            names = _of(owner, c)
            keep = np.flatnonzero(np.isin(names, _of(*_listed(batch["wanted"]))))
            # Once, however often the document has it.
            keep = keep[np.unique(names[keep], return_index=True)[1]]
            owner, at = owner[keep], at[keep]
            place = np.minimum(at, side)
            out = {"anchor": h[keep].view(np.int64), "c": c[keep].view(np.int64), "first": batch["id"].to_numpy(np.int64)[owner], "place": place}
            out["context"] = [texts[k][a:b] for k, a, b in zip(owner.tolist(), (at - place).tolist(), (at + length).tolist())]
            yield pd.DataFrame(out)

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        return _sorted(group, length)

    def contexts(of: str) -> DataFrame:
        sending = full.join(asked.filter(F.size(of) > 0).select("id", F.col(of).alias("wanted")), "id")
        return sending.mapInPandas(around, "anchor bigint, c bigint, first bigint, place int, context binary")

    met = contexts("few").withColumn("bin", F.pmod("anchor", F.lit(_bins(few or 0, length))))
    # Strings of the first holder of a context that an earlier document has.
    special = stored(met.groupBy("bin").applyInPandas(sort, "c bigint, id bigint, starts array<int>"), "earlier-strings", release=True)
    if many:
        special = special.union(_crowded(stored(contexts("many"), "crowded-contexts", release=True), length))
    todo = held.filter("anchor is null").select("id", "c", F.lit(None).cast("array<int>").alias("starts")).union(special.select("id", "c", "starts"))
    whole = F.col("starts").isNull()
    cuts = todo.groupBy("id").agg(
        F.collect_list(F.when(whole, F.col("c"))).alias("whole"), F.collect_list(F.when(~whole, F.struct("c", "starts"))).alias("some")
    )
    cuts = stored(cuts, "cuts", release=True)

    @F.pandas_udf("n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    def cut(texts: pd.Series, whole: pd.Series, some: pd.Series) -> pd.DataFrame:
        out = []
        raws = [_bytes(t) for t in texts]
        owner, at, _, c = anchors([b"" if x is None else raw for raw, x in zip(raws, whole)], length)
        entirely = np.isin(_of(owner, c), _of(*_listed([[] if x is None else x for x in whole])))
        c = c.view(np.int64)
        bounds = np.searchsorted(owner, np.arange(len(raws) + 1)).tolist()
        for raw, entire, strings, low, high in zip(raws, whole, some, bounds, bounds[1:]):
            if entire is None:
                out.append((len(raw), [], raw))
                continue
            gone = np.zeros(len(raw) + 1, np.int64)
            mine = at[low:high][entirely[low:high]]
            np.add.at(gone, np.maximum(mine - (length - GRAM), 0), 1)
            np.add.at(gone, np.minimum(mine, len(raw) - length) + length, -1)
            wanted = {x["c"]: np.asarray(x["starts"], np.int64) for x in strings}
            if wanted:
                for k in (np.flatnonzero(np.isin(c[low:high], np.fromiter(wanted, np.int64))) + low).tolist():
                    starts = wanted[int(c[k])] + max(0, int(at[k]) - (length - GRAM))
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + length, -1)
            covered = np.cumsum(gone[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
            spans = [{"start": int(a), "end": int(b)} for a, b in turns.reshape(-1, 2)]
            out.append((len(raw), spans, np.frombuffer(raw, np.uint8)[~covered].tobytes()))
        return pd.DataFrame(out, columns=["n_bytes", "spans", "kept"])

    done = rows.join(cuts, "id", "left").withColumn("cut", cut("text", "whole", "some"))
    removed = F.col("cut.n_bytes") - F.octet_length("cut.kept")
    return done.select(F.col("id").alias(id_col), "cut.n_bytes", removed.cast("bigint").alias("n_removed"), "cut.spans", "cut.kept")
