"""Language of a text: one interpolated Kneser-Ney model of characters per language.

Texts become lower-case letters with single blanks between words. Every four characters are counted
over all texts of a language; shorter sequences are counted by the number of different characters in front of
them, as Kneser and Ney do. Each model is a few sorted arrays of slots: what a sequence keeps after its discount, and what each
context hands down to the shorter one. A text gets the language whose model needs the fewest
bits a character. A share of the texts is scored by models that have not seen it, which calibrates the score and the
cross-entropy beyond which a text is rejected as none of the languages.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of the longest sequence: four of 16 bits fill a long.
ORDER = 4
#: Sequences of one length and language share 2 ** SLOT_BITS slots: a model has a bounded size whatever it has read.
SLOT_BITS = 20
#: Discount where a model is too small to tell.
DISCOUNT = 0.5
#: One in so many texts calibrates; the share of them that is accepted, and the standard deviations that are anyway.
CALIBRATING, ACCEPTED, DEVIATIONS = 16, 0.999, 4.0
#: Steepness of the score that calibration chooses from.
BETAS = [2.0**k for k in range(-3, 7)]
#: Different sequences that a counting task holds before it sends them on.
HELD = 4_000_000
#: Characters that a scoring task remembers the sequences of, as a power of two.
MEMO_BITS = 19

_BLANK, _PRIVATE = 32, 0xE000


class Letters:
    """Characters to 16-bit codes: lower-case letters, all else is a blank. Letters beyond 16 bits share 6,400 private codes."""

    def __init__(self):
        codes = range(0x10000)
        self.codes = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) if c.isalpha() else _BLANK for c in map(chr, codes)], np.uint16)
        self.codes[[i for i in codes if not chr(i).isalpha()]] = _BLANK
        self.beyond: dict[int, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """Codes of a text with one blank between words and at its end; nothing for a text without letters."""
        if not text:
            return np.empty(0, np.uint16)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        high = points > 0xFFFF
        out = self.codes[np.where(high, 0, points)]
        if high.any():
            for point in np.unique(points[high]):
                c = chr(point).lower()
                self.beyond.setdefault(int(point), _PRIVATE + ord(c[0]) % 6400 if c[0].isalpha() else _BLANK)
            out[high] = [self.beyond[int(p)] for p in points[high]]
        out = np.append(out, np.uint16(_BLANK))
        keep = out != _BLANK
        keep[1:] |= out[:-1] != _BLANK
        return out[keep]

    def sequences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All sequences of ``ORDER`` characters as longs, text by text, and how many each text has.

        A text begins after blanks, so each of its characters ends one sequence.
        """
        each = [self.of(t) for t in texts]
        sizes = np.array([len(x) for x in each], np.int64)
        front = np.full(ORDER - 1, _BLANK, np.uint16)
        row = np.concatenate([p for x in each if len(x) for p in (front, x)] or [front]).astype(np.uint64)
        keys = np.zeros(max(0, len(row) - ORDER + 1), np.uint64)
        for i in range(ORDER):
            keys = (keys << np.uint64(16)) | row[i : len(row) - ORDER + 1 + i]
        full = sizes[sizes > 0]
        starts = np.cumsum(full + ORDER - 1) - (full + ORDER - 1)
        inside = np.zeros(len(keys) + 1, np.int64)
        np.add.at(inside, starts[starts < len(keys)], 1)
        np.add.at(inside, starts + full, -1)
        return keys[np.cumsum(inside[:-1]) > 0], sizes


def slots(keys: np.ndarray, kind: int) -> np.ndarray:
    salt = np.uint64((kind * 0x9E3779B97F4A7C15) % (1 << 64))
    return (mixed(keys.astype(np.uint64) + salt) >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)


@dataclass
class Models:
    """Models of all languages as plain arrays, and what calibration found.

    ``tables[language][kind]`` is a pair of sorted slots and their values. Kind ``2 * k`` holds what sequences of ``k`` characters
    keep, ``2 * k + 1`` what a context of ``k`` characters hands down.
    """

    names: list[str]
    tables: list[list[tuple[np.ndarray, np.ndarray]]]
    mean: list[float] = field(default_factory=list)
    spread: list[float] = field(default_factory=list)
    beta: float = 1.0


def _read(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray, default: float) -> np.ndarray:
    keys, values = table
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def costs(models: Models, keys: np.ndarray) -> np.ndarray:
    """``keys x languages``: the cost, in nats, of the last character of each sequence after those in front of it."""
    out = np.empty((len(keys), len(models.names)))
    suffixes = [keys & np.uint64((1 << 16 * k) - 1) for k in range(1, ORDER)] + [keys]
    kept = [slots(suffixes[k - 1], 2 * k) for k in range(1, ORDER + 1)]
    handed = [slots(suffixes[k] >> np.uint64(16), 2 * k + 1) for k in range(ORDER)]
    for i, tables in enumerate(models.tables):
        chance = np.full(len(keys), 2.0**-16)
        for k in range(1, ORDER + 1):
            # A context never seen hands down all.
            chance = _read(tables[2 * k], kept[k - 1], 0.0) + _read(tables[2 * k - 1], handed[k - 1], 1.0) * chance
        out[:, i] = -np.log(np.minimum(1.0, chance))
    return out


class Scorer:
    """Cross-entropy of texts under all models; remembers sequences it has seen."""

    def __init__(self, models: Models):
        self.models, self.letters = models, Letters()
        self.keys = np.zeros(1 << MEMO_BITS, np.uint64)
        self.costs = np.zeros((1 << MEMO_BITS, len(models.names)), np.float32)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``texts x languages`` nats a character, and the characters of each text."""
        keys, sizes = self.letters.sequences(texts)
        out = np.zeros((len(texts), len(self.models.names)))
        full = sizes > 0
        if full.any() and self.models.names:
            place = (mixed(keys) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
            new = np.flatnonzero(self.keys[place] != keys)
            each = self.costs[place]
            if len(new):
                wanted = np.unique(keys[new])
                found = costs(self.models, wanted).astype(np.float32)
                each[new] = found[np.searchsorted(wanted, keys[new])]
                at = (mixed(wanted) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
                at, which = np.unique(at, return_index=True)
                self.keys[at], self.costs[at] = wanted[which], found[which]
            starts = np.cumsum(sizes[full]) - sizes[full]
            # Language by language, in double precision.
            sums = np.stack([np.add.reduceat(each[:, i].astype(float), starts) for i in range(each.shape[1])], axis=1)
            out[full] = sums / sizes[full, None]
        return out, sizes


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``lang, calibrating, gram, n`` of the texts of a task."""
    letters, held = Letters(), {}

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts

    def sent() -> Iterator[pd.DataFrame]:
        for (lang, calibrating), parts in held.items():
            keys, counts = merged(parts)
            yield pd.DataFrame({"lang": lang, "calibrating": calibrating, "gram": keys.view(np.int64), "n": counts})
        held.clear()

    size = 0
    for batch in batches:
        for name, part in batch.groupby(["lang", "calibrating"]):
            keys, counts = np.unique(letters.sequences(part["text"].tolist())[0], return_counts=True)
            parts = held.setdefault(name, [])
            parts.append((keys, counts))
            size += len(keys)
            if len(parts) >= 16:
                size -= sum(len(k) for k, _ in parts)
                held[name] = [merged(parts)]
                size += len(held[name][0][0])
        if size > HELD:
            yield from sent()
            size = 0
    yield from sent()


def _levels(counts: DataFrame) -> Iterator[DataFrame]:
    """``lang, kind, slot, value`` of the models made from ``lang, gram, n``, from the longest sequences to single characters."""

    @F.pandas_udf("int")
    def slot(keys: pd.Series, kinds: pd.Series) -> pd.Series:
        out = np.empty(len(keys), np.int32)
        for kind in kinds.unique():
            at = (kinds == kind).to_numpy()
            out[at] = slots(keys.to_numpy()[at].view(np.uint64), int(kind))
        return pd.Series(out)

    level = counts
    for k in range(ORDER, 0, -1):
        level = stored(level, f"sequences-{k}")
        once, twice = F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))
        share = F.when((once == 0) | (twice == 0), DISCOUNT).otherwise(once / (once + 2 * twice))
        discounts = level.groupBy("lang").agg(F.greatest(F.lit(0.05), F.least(F.lit(0.95), share)).alias("d"))
        parts = level.withColumn("context", F.shiftrightunsigned("gram", 16))
        contexts = parts.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        contexts = stored(contexts.join(discounts, "lang"), "contexts")
        handed = F.col("d") * F.col("kinds") / F.col("total")
        handed = contexts.select("lang", F.lit(2 * k - 1).alias("kind"), F.col("context").alias("key"), handed.alias("value"))
        kept = parts.join(contexts, ["lang", "context"])
        kept = kept.select("lang", F.lit(2 * k).alias("kind"), F.col("gram").alias("key"), ((F.col("n") - F.col("d")) / F.col("total")).alias("value"))
        rows = handed.unionByName(kept).withColumn("slot", slot("key", "kind"))
        # Sequences that share a slot share its largest value.
        yield rows.groupBy("lang", "kind", "slot").agg(F.max(F.col("value").cast("float")).alias("value"))
        if k > 1:
            level = level.groupBy("lang", F.col("gram").bitwiseAND((1 << 16 * (k - 1)) - 1).alias("gram")).agg(F.count("*").alias("n"))


def _models(counts: DataFrame) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
    """Tables of each ``lang`` of the counts."""
    empty = np.empty(0, np.uint32), np.empty(0, np.float32)
    out: dict[str, list] = {}
    for level in _levels(counts):
        # At most 2 ** SLOT_BITS rows for each language and kind.
        rows = level.toArrow()
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        which, kind = langs.indices.to_numpy(zero_copy_only=False), rows.column("kind").to_numpy()
        slot, value = rows.column("slot").to_numpy().astype(np.uint32), rows.column("value").to_numpy().astype(np.float32)
        for i, name in enumerate(langs.dictionary.to_pylist()):
            tables = out.setdefault(name, [empty] * (2 * ORDER + 1))
            for one in np.unique(kind[which == i]):
                mine = np.flatnonzero((which == i) & (kind == one))
                mine = mine[np.argsort(slot[mine])]
                tables[one] = slot[mine], value[mine]
    return out


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Models:
    """Models of all languages of ``docs``, from every row whose language and text are not null.

    Texts without a letter teach nothing, and a language with no other texts is not learned. Repeated rows
    count each time. Without any text there is no language. The driver holds the models: for each language at most
    ``2 * ORDER * 2 ** SLOT_BITS`` slots of eight bytes. Other columns are not looked at.
    """
    spark = docs.sparkSession
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    known = known.withColumn("calibrating", F.pmod(F.xxhash64("text"), F.lit(CALIBRATING)) == 0)
    counts = known.mapInPandas(_counted, "lang string, calibrating boolean, gram bigint, n bigint")
    counts = counts.groupBy("lang", "calibrating", "gram").agg(F.sum("n").alias("n"))
    # Models of all texts, and others that have not seen those that calibrate.
    kinds = F.explode(F.when(F.col("calibrating"), F.array(F.lit("all:"))).otherwise(F.array(F.lit("all:"), F.lit("blind:"))))
    counts = counts.withColumn("kind", kinds).groupBy(F.concat("kind", "lang").alias("lang"), "gram").agg(F.sum("n").alias("n"))
    made = _models(counts)
    models, blind = (
        Models(names, [made[kind + name] for name in names])
        for kind in ("all:", "blind:")
        for names in [sorted(x.removeprefix(kind) for x in made if x.startswith(kind))]
    )
    models.mean, models.spread = [0.0] * len(models.names), [float("inf")] * len(models.names)
    if not blind.names:
        return models
    shared = spark.sparkContext.broadcast((blind.names, blind.tables))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(Models(*shared.value))
        place = {name: i for i, name in enumerate(scorer.models.names)}
        for batch in batches:
            found, sizes = scorer.entropies(batch["text"].tolist())
            at = batch["lang"].map(place)
            ok = at.notna().to_numpy() & (sizes > 0)
            own = found[ok, at[ok].to_numpy(int)]
            yield pd.DataFrame({"lang": batch["lang"][ok], "n": sizes[ok], "own": own, "behind": list(found[ok] - own[:, None])})

    seen = known.filter("calibrating").select("lang", "text").mapInPandas(measured, "lang string, n bigint, own double, behind array<double>")
    seen = stored(seen, "calibration")
    root = F.sqrt(F.col("n").cast("double"))

    def loss(beta: float) -> Column:
        return F.log(F.aggregate("behind", F.lit(0.0), lambda s, x: s + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -beta * root * x)))))

    losses = seen.agg(*[F.round(F.sum(loss(b)), 6).alias(f"b{i}") for i, b in enumerate(BETAS)]).first()
    if losses[0] is not None:
        models.beta = min(zip(losses, BETAS))[1]
    means = seen.groupBy("lang").agg((F.sum(F.col("own") * F.col("n")) / F.sum("n")).alias("mean"))
    excess = (F.col("own") - F.col("mean")) * root
    spreads = seen.join(F.broadcast(means), "lang").groupBy("lang", "mean").agg(  # a row for each language
        F.greatest(F.percentile_approx(excess, ACCEPTED, 10_000), DEVIATIONS * F.stddev(excess)).alias("spread"), F.count("*").alias("n")
    ).filter("n > 1")
    for row in spreads.collect():
        i = models.names.index(row["lang"])
        models.mean[i], models.spread[i] = row["mean"], row["spread"]
    return models


def predict(text: Column | str, models: Models) -> Column:
    """``lang, score, nats, rejected`` of each whole text.

    ``lang`` has the lowest cross-entropy a character, ``nats``; ties go to the name that sorts first. ``score`` is 0 to 1, the calibrated
    chance of that language among those learned. ``rejected`` says that ``nats`` is beyond what the language's own texts of that length
    have: all but one in a thousand of them, or four standard deviations where that is more (with fewer than two texts to tell from, none
    is rejected). A null text, or one without a letter, is ``und`` with score 0 and no ``nats``, and
    rejected; so are all texts where no language is learned.
    """
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast((models.names, models.tables))
    mean, spread, beta = np.array(models.mean), np.array(models.spread), models.beta

    def judged(scorer: Scorer, texts: pd.Series) -> pd.DataFrame:
        names = scorer.models.names
        found, sizes = scorer.entropies(texts.tolist())
        out = pd.DataFrame({"lang": "und", "score": 0.0, "nats": None, "rejected": True}, index=range(len(texts)))
        full = sizes > 0
        if full.any() and names:
            best = found[full].argmin(axis=1)
            nats = found[full].min(axis=1)
            root = np.sqrt(sizes[full])
            score = 1 / np.exp(np.maximum(-700, -beta * root[:, None] * (found[full] - nats[:, None]))).sum(axis=1)
            out.loc[full, "lang"] = np.array(names, object)[best]
            out.loc[full, "score"] = score
            out.loc[full, "nats"] = nats
            out.loc[full, "rejected"] = (nats - mean[best]) * root > spread[best]
        return out

    @F.pandas_udf("lang string, score double, nats double, rejected boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(Models(*shared.value))
        for texts in batches:
            yield judged(scorer, texts)

    return judge(F.col(text) if isinstance(text, str) else text)
