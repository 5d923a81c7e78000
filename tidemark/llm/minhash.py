"""Near duplicates by b-bit MinHash.

Texts with the same words form a class; one signature is made for each class. Minima are put
into bands, and a bucket holds the classes that share all minima of a band. Only the low bits of
each minimum are kept, packed into longs; bit counts of two packed signatures give an estimate
of similarity, corrected for low bits that agree by chance. What passes the estimate is confirmed
on the full shingle sets.

No bucket is expanded into all its pairs. The class that shares most buckets with others is the
center of its buckets, and each class is confirmed against its centers, so that large groups grow
together in linear work. What then still differs from its center's component is compared with the
other members of that center's buckets, inside tasks: signatures first, then whole sets, and only
links come out. Links inside a component would change nothing and are not looked for.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, components, shingles, stored, words_of
from tidemark.session import using

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASHES, ROWS, BITS = 180, 5, 2
#: Chance that a pair right at the threshold shares no band.
MISSED = 1e-6
#: Standard errors that an estimate may lie below the threshold before a pair is let go.
SIGMAS = 5
#: Shingles of one side of a comparison in one task.
LOAD = 2_000_000
#: Shingles hashed at a time.
CHUNK = 1 << 20


def _signatures(chunk: list[np.ndarray], n: int, seed: int) -> np.ndarray:
    """Minima of each set under ``n`` hash functions."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
    shifts = rng.integers(1, 1 << 63, n, dtype=np.uint64)
    flat = np.concatenate(chunk)
    starts = np.cumsum([0, *map(len, chunk[:-1])])
    out = np.empty((len(chunk), n), np.uint64)
    room = np.empty_like(flat)
    for k in range(n):
        np.multiply(flat, factors[k], out=room)
        np.add(room, shifts[k], out=room)
        out[:, k] = np.minimum.reduceat(room, starts) >> np.uint64(24)
    return out


def _packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of each minimum, as many to a long as fit."""
    each = 64 // bits
    low = minima & np.uint64((1 << bits) - 1)
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % each))).reshape(len(low), -1, each)
    return (low << (np.arange(each, dtype=np.uint64) * np.uint64(bits))).sum(axis=2, dtype=np.uint64).view(np.int64)


def _buckets(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit name for each band and its minima."""
    parts = minima[:, : bands * rows].reshape(len(minima), bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(minima), 1), np.uint64)
    for r in range(rows):
        out = (out ^ parts[:, :, r]) * np.uint64(0xC4CEB9FE1A85EC53)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, n: int, bands: int, rows: int, bits: int, seed: int) -> DataFrame:
    """``id, n_shingles, v`` (128-bit name of the word sequence), ``sig, buckets``; no words: null."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()

        def flush(ids, sets, names):
            full = [i for i, s in enumerate(sets) if len(s)]
            sig: list = [None] * len(ids)
            buckets: list = [None] * len(ids)
            if full:
                minima = _signatures([sets[i] for i in full], n, seed)
                for i, s, b in zip(full, _packed(minima, bits), _buckets(minima, bands, rows)):
                    sig[i], buckets[i] = s, b
            return pd.DataFrame({"id": pd.array(ids, "Int64"), "n_shingles": [len(s) for s in sets], "v": names, "sig": sig, "buckets": buckets})

        for batch in batches:
            ids, sets, names, held = [], [], [], 0
            for i, text in zip(batch["id"], batch["text"]):
                words = words_of(text)
                ids.append(None if pd.isna(i) else int(i))
                sets.append(shingles(known.of(words), size))
                names.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                held += len(sets[-1])
                if held >= CHUNK:
                    yield flush(ids, sets, names)
                    ids, sets, names, held = [], [], [], 0
            if ids:
                yield flush(ids, sets, names)

    return docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(
        make, "id bigint, n_shingles bigint, v binary, sig array<bigint>, buckets array<bigint>"
    )


def _agreeing(bits: int, longs: int, n: int) -> Column:
    """How many of ``n`` packed minima of ``sig_a`` and ``sig_b`` agree in their low bits."""
    ones = sum(1 << i for i in range(0, 64, bits))
    ones -= (ones >> 63) << 64
    differing = F.lit(0)
    for k in range(longs):
        x = F.col("sig_a")[k].bitwiseXOR(F.col("sig_b")[k])
        folded = x
        for i in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, i))
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(ones)))
    return F.lit(n) - differing


def least_agreeing(percent: int, bits: int, n: int) -> int:
    """Agreeing minima below which a pair of the wanted similarity is all but impossible."""
    chance = 2.0**-bits
    p = percent / 100 + (1 - percent / 100) * chance
    return max(0, math.floor(n * p - SIGMAS * math.sqrt(n * p * (1 - p))))


def bands_for(percent: int, rows: int) -> int:
    """How many bands of ``rows`` minima let at most ``MISSED`` of the pairs at the threshold escape."""
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** rows))) if percent < 100 else 1


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` with ``100 * common >= percent * union`` of their whole shingle sets."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, kept = WordHashes(), (None, None)
        for batch in batches:
            good = []
            for one, two in zip(batch["text_b"], batch["text_a"]):
                if kept[0] != one:
                    kept = (one, shingles(known.of(words_of(one)), size))
                second = shingles(known.of(words_of(two)), size)
                common = len(np.intersect1d(kept[1], second, assume_unique=True))
                good.append(100 * common >= percent * (len(kept[1]) + len(second) - common))
            yield batch.loc[good, ["a", "b"]]

    side = lambda x: texts.select(F.col("v").alias(x), F.col("text").alias(f"text_{x}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInPandas(check, "a binary, b binary")


def _dealt(left: DataFrame, right: DataFrame, load: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``i, j``: every pair of a ``center``'s left and right rows meets in one ``(center, i, j)``.

    Centers whose rows weigh more than ``LOAD`` by column ``load`` are dealt over several tasks.
    """
    parts = lambda df, n: df.groupBy("center").agg(F.ceil(F.sum(load) / LOAD).cast("int").alias(n))
    both = stored(parts(left, "lefts").join(parts(right, "rights"), "center").filter("lefts > 1 or rights > 1"), "minhash-blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    mine = lambda n: F.pmod(F.xxhash64("v"), F.coalesce(n, F.lit(1))).cast("int")
    one = left.join(both, "center", "left").withColumn("i", mine(F.col("lefts"))).withColumn("j", every(F.col("rights")))
    two = right.join(both, "center", "left").withColumn("j", mine(F.col("rights"))).withColumn("i", every(F.col("lefts")))
    # New names for both sides: they may come from the same table.
    return tuple(df.select(*[F.col(c).alias(c) for c in df.columns if c not in ("lefts", "rights")]) for df in (one, two))


def _likely(left: pd.DataFrame, right: pd.DataFrame, bits: int, n: int, least: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each left row, the right rows of other components that may be similar: by size and by bit counts."""
    if not len(left) or not len(right):
        return
    sigs = np.stack(right["sig"].to_numpy()).astype(np.int64).view(np.uint64)
    sizes, roots = right["n"].to_numpy(np.int64), right["root"].to_numpy()
    ones = np.uint64(sum(1 << i for i in range(0, 64, bits)))
    for k, (sig, size, root) in enumerate(zip(left["sig"], left["n"], left["root"])):
        at = np.flatnonzero((roots != root) & (100 * sizes >= percent * size) & (100 * size >= percent * sizes))
        if len(at):
            x = sigs[at] ^ np.asarray(sig, np.int64).view(np.uint64)
            folded = x
            for i in range(1, bits):
                folded = folded | (x >> np.uint64(i))
            at = at[n - np.bitwise_count(folded & ones).sum(axis=1, dtype=np.int64) >= least]
            if len(at):
                yield k, at


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
    hashes: int = HASHES, rows: int = ROWS, bits: int = BITS, seed: int = 8,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles, component_id, kept``.

    Texts are linked when ``100 * common >= percent * union`` of their sets of ``size``-word
    shingles. ``component_id`` is the smallest id reachable over links, ``kept`` marks its rows.

    Null and empty texts, and texts without words, have no shingles and stand alone. A null id
    stands alone: null component, kept. Repeated rows share a component and are all kept or all
    not; rows that repeat an id with other words are judged by their words. Other columns of
    ``docs`` are not looked at. An empty table gives an empty result.
    """
    if 64 % bits:
        raise ValueError("bits must divide 64")
    bands = bands_for(percent, rows)
    n = max(hashes, bands * rows)
    made = stored(signatures(docs, id_col, text_col, size, n, bands, rows, bits, seed), "minhash", release=True)
    classes = stored(
        made.filter("id is not null and v is not null").groupBy("v").agg(
            F.min("id").alias("first"), F.min("n_shingles").alias("n"), F.min_by("sig", "id").alias("sig"), F.min_by("buckets", "id").alias("buckets")
        ),
        "minhash-classes",
    )
    names = classes.select(F.explode("buckets").alias("bucket"), "v")
    shared = stored(names.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1"), "minhash-shared")
    members = stored(names.join(shared, "bucket"), "minhash-members")
    weights = stored(members.groupBy("v").agg(F.sum("rows").alias("weight")), "minhash-weights")
    centers = stored(
        members.select("bucket", "v").join(weights, "v").groupBy("bucket").agg(F.max_by("v", F.struct("weight", "v")).alias("center")), "minhash-centers"
    )
    groups = stored(members.select("bucket", "v").join(centers, "bucket").select("center", "v").distinct(), "minhash-groups", release=True)
    # Whole texts of the classes that share a bucket, one row each.
    heads = classes.join(weights, "v", "left_semi")
    wanted = stored(heads.select("v", "first", "n"), "minhash-heads")
    # Spark's own filter of bounded size keeps most other texts out of the shuffle.
    with using(docs.sparkSession, {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB"}):
        texts = stored(_texts_of(docs, wanted, id_col, text_col), "minhash-texts", release=True)
    signed = stored(heads.select("v", "sig", "n"), "minhash-signed")

    side = lambda x: signed.select(F.col("v").alias(x), F.col("sig").alias(f"sig_{x}"))
    agreeing, least = _agreeing(bits, -(-n // (64 // bits)), n), least_agreeing(percent, bits, n)
    pairs = groups.select(F.col("v").alias("a"), F.col("center").alias("b")).filter("a != b")
    likely = stored(pairs.join(side("b"), "b").join(side("a"), "a").filter(agreeing >= least).select("a", "b"), "minhash-pairs", release=True)
    roots = components(stored(_confirm(likely, texts, size, percent), "minhash-links"))

    # Members whose component is not their center's, against all members of that center.
    rooted = signed.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    rooted = stored(rooted, "minhash-rooted")
    here = groups.join(rooted, "v").join(rooted.select(F.col("v").alias("center"), F.col("root").alias("center_root")), "center")
    here = stored(here, "minhash-here", release=True)
    apart = here.filter("root != center_root").drop("center_root")
    around = here.drop("center_root").join(apart.select("center").distinct(), "center", "left_semi")

    def alive(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        ends = set()
        for k, at in _likely(one, two, bits, n, least, percent):
            ends.add(one["v"].iloc[k])
            ends.update(two["v"].to_numpy()[at])
        return pd.DataFrame({"center": one["center"].iloc[:1].tolist() * len(ends), "v": list(ends)})

    keys = ["center", "i", "j"]
    one, two = _dealt(apart.withColumn("load", F.lit(100)), around.withColumn("load", F.lit(100)), "load")
    near = one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(alive, "center binary, v binary")
    near = stored(near.distinct(), "minhash-near", release=True)

    def confirm(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        known, out = WordHashes(), []
        sets = [shingles(known.of(words_of(t)), size) for t in two["text"]]
        for k, at in _likely(one, two, bits, n, least, percent):
            own = shingles(known.of(words_of(one["text"].iloc[k])), size)
            flat = np.concatenate([sets[i] for i in at])
            sizes = np.array([len(sets[i]) for i in at])
            hits = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            common = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes) - sizes)
            for i in at[100 * common >= percent * (len(own) + sizes - common)]:
                out.append((one["v"].iloc[k], two["v"].iloc[i]))
        # Links to one component are as good as one link.
        out = pd.DataFrame(out, columns=["a", "b"])
        return out.loc[~out.assign(root=out["b"].map(dict(zip(two["v"], two["root"])))).duplicated(["a", "root"])] if len(out) else out

    texted = near.join(texts, "v")
    one, two = _dealt(apart.join(texted, ["center", "v"]), around.join(texted, ["center", "v"]), "n")
    last = stored(one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(confirm, "a binary, b binary").distinct(), "minhash-links", release=True)
    # The components found so far are one link per member.
    roots = components(roots.select(F.col("v").alias("a"), F.col("root").alias("b")).filter("a != b").union(last))

    placed = classes.select("v", "first").join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    lowest = stored(placed.groupBy("root").agg(F.min("first").alias("component")), "minhash-lowest")
    named = stored(placed.join(lowest, "root").select("v", "component"), "minhash-named")
    rows_ = made.select("id", "n_shingles", "v").join(named, "v", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows_.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _texts_of(docs: DataFrame, heads: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``v, text`` for each class of ``heads``: the text of its first row."""

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = [xxhash.xxh3_128_digest(b" ".join(words_of(t))) if t else None for t in batch["text"]]
            yield pd.DataFrame({"v": names, "text": batch["text"]})[[a == b for a, b in zip(names, batch["v"])]]

    wanted = docs.select(F.col(id_col).alias("first"), F.col(text_col).alias("text")).join(heads.filter("n > 0"), "first")
    return wanted.select("v", "text").mapInPandas(name, "v binary, text string").dropDuplicates(["v"])
