"""Toxicity of disguised texts: a noisy channel undone by Viterbi decoding, then a lexicon.

A disguised word is a lattice: each character may stand for itself, for the letter it imitates, or
for nothing (a separator, or one more copy of a repeated letter). A character model of four letters,
counted over the whole corpus, picks the likeliest reading. Words and word beginnings of the
restored text are looked up in a lexicon learned from labelled rows, and a logistic model weighs
what was found.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Symbols of the character model: 0 is a word's edge, 1 to 26 are a to z, 27 is any other letter.
SYMBOLS, ORDER = 28, 4
#: Letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
    "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h",
}
#: Log probabilities of the channel.
IMITATES, DROPPED, REPEATED, ENDS_WORD = -1.0, -1.0, -0.3, -2.5
#: Readings kept at each character.
BEAM = 24
#: Word beginnings looked up, by length.
STEMS = (3, 4, 5, 7)
#: Share of toxic rows from which one feature is enough.
ALONE = 0.7
#: Restored words a worker remembers before it forgets all and starts anew.
REMEMBERED = 200_000

_CODE = np.zeros(256, np.int32)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
_EDGES = ".,;:!?\"'()[]{}<>|-_=~`/\\*%&#$@+^"
_DECORATED = re.compile(r"([^\w\s])\1\1+$")
_LONG = re.compile(r"(.)\1{3,}", re.DOTALL)
#: Marks around a word that stand for no letter.
_OUTER = "".join(c for c in _EDGES if c not in LEET)
_LEET = "".join(LEET)
#: Marks that ordinary words have inside.
_INNER = "'\u2019,/:;"
#: A double character, one that may stand for another, marks between letters, or an inner mark between single letters.
_ODD = re.compile(
    r"(.)\1|[" + re.escape(_LEET) + r"]|[^\W\d_](?:[^\w\s" + _INNER + r"]+|_+)[^\W\d_]"
    r"|(?<![^\W\d_])[^\W\d_][" + _INNER + r"][^\W\d_](?![^\W\d_])",
    re.DOTALL,
)
_CLOSED_UP = re.compile(r"(?<=[^\W\d_])[" + _INNER + r"]+(?=[^\W\d_])")
#: Marks without a width go; the wide forms of ASCII are 0xFEE0 above it.
_WIDTHS = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff\uff01-\uff5e]")
_NARROW = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]) | {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
#: Letters of other scripts that look like a Latin one.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "α": "a", "ο": "o", "ι": "i", "ν": "v", "ρ": "p", "κ": "k", "ı": "i", "ɡ": "g",
}
_LOOKALIKES = str.maketrans(LOOKALIKES)
#: Characters decoded at once, and how many of them overlap.
WINDOW, OVERLAP = 200, 40


def _gram_codes(raw: np.ndarray) -> np.ndarray:
    """Numbers of the character groups that end at each letter, or at the edge after one."""
    code = np.concatenate((np.zeros(ORDER - 1, np.int32), _CODE[raw], np.zeros(1, np.int32)))
    n = len(code) - ORDER + 1
    parts = [code[i : n + i] for i in range(ORDER)]
    # What lies before the last edge is another word.
    for i in range(ORDER - 2, 0, -1):
        parts[i - 1] = np.where(parts[i] == 0, 0, parts[i - 1])
    out = parts[0]
    for p in parts[1:]:
        out = out * SYMBOLS + p
    return out[(parts[-1] > 0) | (parts[-2] > 0)]


def count_grams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of all character groups of the corpus, added up by Spark.

    The table has ``SYMBOLS ** ORDER`` entries whatever the corpus; a task sends each entry once.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        for batch in batches:
            # Texts end to end with a blank between: long texts are cut, short ones are joined.
            raw = b" ".join(t.encode("utf-8", "surrogatepass") for t in batch["text"])
            for i in range(0, len(raw), 1 << 20):
                codes = _gram_codes(np.frombuffer(raw[i : i + (1 << 20)], np.uint8))
                total += np.bincount(codes, minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    counted = texts.mapInPandas(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS**ORDER, np.float64)
    out[counted["gram"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a symbol after three others, smoothed by shorter contexts."""
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        table = counts.reshape(-1, *[SYMBOLS] * order).sum(axis=0)
        weight = 5.0
        lower = (table + weight * lower) / (table.sum(axis=-1, keepdims=True) + weight)
    return np.log(lower).astype(np.float32).reshape(-1, SYMBOLS)


class Restorer:
    """Viterbi decoding of character lattices under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = model.ravel().tolist()
        self.choices: dict[tuple[str | None, int, bool], list[tuple[int | None, str, float]]] = {}

    def decode(self, text: str, letters: bool = False) -> str:
        """The likeliest reading of one disguised stretch: words between single blanks.

        With ``letters`` every character that may stand for a letter does.
        """
        model, kept = self.model, SYMBOLS ** (ORDER - 1)
        states: dict[int, tuple[float, str]] = {0: (0.0, "")}
        # While there is one state it is kept apart.
        state, score, out, single = 0, 0.0, "", True
        last, run = "", 0
        for c in [*text.lower(), None]:
            run = run + 1 if c == last else 1
            last = c or ""
            if single:
                if run == 1 and last.isalpha():
                    # A letter that stands for itself only.
                    at = state * SYMBOLS + (ord(last) - 96 if "a" <= last <= "z" else 27)
                    state, score, out = at % kept, score + model[at], out + last
                    continue
                states = {state: (score, out)}
            # Runs of three and more are alike.
            key = (c, min(run, 3), letters)
            options = self.choices.get(key)
            if options is None:
                options = self.choices[key] = self._options(*key)
            following: dict[int, tuple[float, str]] = {}
            for state, (score, out) in states.items():
                row = state * SYMBOLS
                for symbol, shown, cost in options:
                    if symbol is None or symbol == 0 and state % SYMBOLS == 0:
                        new, now, written = state, score + cost, out
                    else:
                        new = (row + symbol) % kept if symbol else 0
                        now, written = score + cost + model[row + symbol], out + shown
                    old = following.get(new)
                    if old is None or now > old[0]:
                        following[new] = (now, written)
            if len(following) > BEAM:
                following = dict(sorted(following.items(), key=lambda x: -x[1][0])[:BEAM])
            states = following
            single = len(states) == 1
            if single:
                ((state, (score, out)),) = states.items()
        return max(states.values())[1].strip()

    @staticmethod
    def _options(c: str | None, run: int, letters: bool = False) -> list[tuple[int | None, str, float]]:
        """Symbol, what it adds to the text, and log probability of the channel."""
        if c is None:
            return [(0, "", 0.0)]
        if c.isspace():
            return [(0, " ", ENDS_WORD), (None, "", DROPPED)]
        if c.isalpha():
            symbol = ord(c) - 96 if "a" <= c <= "z" else 27
            out: list[tuple[int | None, str, float]] = [(symbol, c, 0.0)]
            return out + [(None, "", REPEATED)] if run > 1 else out
        out = [(ord(x) - 96, x, IMITATES) for x in LEET.get(c, "")]
        if out and letters:
            return out + [(None, "", REPEATED)] if run > 2 else out
        out.append((0, " ", ENDS_WORD))
        return out + [(None, "", REPEATED if run > 1 else DROPPED * (1 if not c.isdigit() else 3))]


def disguised(word: str) -> bool:
    """Whether a word has a character that may stand for another, a double one, or marks between letters."""
    return bool(_ODD.search(word))


class Lookup:
    """Features of texts: restored words, and their beginnings (``stem~``).

    With ``features`` only those are looked for, and given by number.
    """

    def __init__(self, restorer: Restorer, features: dict[str, int] | None = None):
        self.restorer, self.features = restorer, features
        self.whole = {f: k for f, k in (features or {}).items() if not f.endswith("~")}
        self.stems = {n: {f[:-1]: k for f, k in (features or {}).items() if len(f) == n + 1 and f.endswith("~")} for n in STEMS}
        self.restored: dict[str, list[str]] = {}
        self.plain: set[str] = set()

    def restore(self, word: str) -> list[str]:
        got = self.restored.get(word)
        if got is None:
            got = []
            # Marks at the end may be emphasis or letters.
            for form in {_DECORATED.sub("", word), word} if word[-1] in _LEET else {_DECORATED.sub("", word)}:
                bare = form.strip(_OUTER).rstrip("(")
                if disguised(bare):
                    got = got + self.decode(bare)
                    if len(bare) < WINDOW - OVERLAP and any(c in LEET for c in bare):
                        # The likeliest reading may drop a mark: "a$$" without its last letters.
                        got = got + self.restorer.decode(bare, letters=True).split()
                elif _CLOSED_UP.search(bare):
                    got = [*got, _CLOSED_UP.sub("", bare)]
            if len(self.restored) >= REMEMBERED:
                self.restored.clear()
            self.restored[word] = got
        return got

    def decode(self, stretch: str) -> list[str]:
        """Words of a stretch of any length; long ones in windows that overlap."""
        if len(stretch) < WINDOW - OVERLAP:
            return self.restorer.decode(stretch).split()
        stretch = _LONG.sub(r"\1\1\1", stretch)
        out: set[str] = set()
        for i in range(0, len(stretch), WINDOW):
            part = stretch[max(0, i - OVERLAP) : i + WINDOW]
            got = self.restored.get(part + " ")
            if got is None:
                got = self.restored[part + " "] = self.restorer.decode(part).split()
            out.update(got)
        return list(out)

    def forms(self, token: str) -> set[str]:
        """A token as written without marks at the edges, and as restored."""
        out = {token.strip(_EDGES)}
        if _ODD.search(token) or _CLOSED_UP.search(token):
            out.update(self.restore(token))
        if not token.isascii():
            # A word that look-alikes turn into a Latin one is meant as that.
            latin = token.translate(_LOOKALIKES)
            if latin.isascii():
                out |= self.forms(latin)
        return out

    def remember_plain(self, token: str) -> None:
        if len(self.plain) >= REMEMBERED:
            self.plain.clear()
        self.plain.add(token)

    @staticmethod
    def tokens(text: str) -> list[str]:
        narrow = text.isascii() or not _WIDTHS.search(text)
        return (text if narrow else text.translate(_NARROW)).lower().split()

    def words(self, text: str) -> set[str]:
        """Distinct words of a text: as written without marks at the edges, and as restored."""
        order = self.tokens(text)
        tokens = set(order)
        out = {w.strip(_EDGES) for w in tokens}
        # What is decoded is remembered, and so is what needs no decoding.
        for w in tokens - self.plain:
            forms = self.forms(w)
            out.update(forms)
            if len(forms) == 1 and w not in self.restored:
                self.remember_plain(w)
        out.update(self.spelled(order))
        out.discard("")
        return out

    def spelled(self, order: list[str]) -> set[str]:
        """Words spelled by single characters."""
        out: set[str] = set()
        # Runs of three or more single characters, whatever blanks are between.
        short = np.fromiter(map(len, order), np.int64, len(order)) == 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], short.astype(np.int8), [0]))))
        for low, high in zip(edges[::2], edges[1::2]):
            # A run of one letter over and over spells nothing, however long it is.
            if high - low > 2 and len(set(order[low:high])) > 1:
                out.update(self.decode(" ".join(order[low:high])))
                out.update(self.restore("".join(order[low:high])))
        return out

    def numbers(self, words: set[str]) -> set[int]:
        """Numbers of the features that words have."""
        out = {self.whole[w] for w in self.whole.keys() & words}
        for n, stems in self.stems.items():
            if stems:
                out.update(stems[w] for w in stems.keys() & {w[:n] for w in words})
        return out

    def text(self, text: str | None) -> set:
        """Distinct features of a whole text."""
        if not text:
            return set()
        if self.features is None:
            words = self.words(text)
            return words.union(*({w[:n] + "~" for w in words if len(w) >= n} for n in STEMS))
        order = self.tokens(text)
        tokens = set(order) - self.plain
        found = set().union(*map(self.forms, tokens))
        out = self.numbers(found | self.spelled(order))
        if not out:
            # Tokens that have no feature now never will.
            if len(self.plain) + len(tokens) > REMEMBERED:
                self.plain.clear()
            self.plain |= tokens
        return out


def specific(found: list[tuple[str, int]]) -> list[str]:
    """Features less the stems that one longer feature accounts for; ``found``: feature, toxic rows."""
    longest: dict[str, int] = {}
    for f, n in found:
        bare = f.removesuffix("~")
        for k in STEMS:
            if k < len(bare) or k == len(bare) and not f.endswith("~"):
                longest[bare[:k]] = max(longest.get(bare[:k], 0), n)
    return [f for f, n in found if not (f.endswith("~") and longest.get(f[:-1], 0) >= 0.6 * n)]


class Model:
    """Character model, lexicon, its weights together, and what each feature says alone."""

    def __init__(self, model: np.ndarray, features: dict[str, int], weights: np.ndarray, base: float, alone: np.ndarray):
        self.model, self.features, self.weights, self.base, self.alone = model, features, weights, base, alone

    def lookup(self) -> Lookup:
        return Lookup(Restorer(self.model), self.features)

    def score(self, found: set[int]) -> float:
        """Probability from all features, or from the surest one: words that always came together may come alone."""
        at = list(found)
        together = float(1 / (1 + np.exp(-(self.base + self.weights[at].sum()))))
        return max(together, float(self.alone[at].max())) if at else together


def alone(hits: np.ndarray, n: np.ndarray, z: float = 3.0) -> np.ndarray:
    """Lower bound (Wilson) of the toxic share of a feature's rows; 0 where it is below ``ALONE``."""
    n = np.maximum(n, 1e-9)
    p = hits / n
    bound = (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return np.where(bound >= ALONE, bound, 0.0)


def _weigh(rows: list[list[int]], y: np.ndarray, n: int, ridge: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic weights of 0/1 features, by gradient descent with momentum."""
    share = (y.sum() + 1) / (len(y) + 2)
    base, weights = float(np.log(share / (1 - share))), np.zeros(n)
    if not n or not len(y):
        return weights, base
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([f for r in rows for f in r], np.int64)
    often = np.bincount(col, minlength=n) + 1.0
    speed, speed_base = np.zeros(n), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(base + np.bincount(row, weights[col], len(rows)))))
        off = y - p
        speed = 0.9 * speed + (np.bincount(col, off[row], n) - ridge * weights * 0.2) / often
        speed_base = 0.9 * speed_base + off.mean()
        weights, base = weights + 0.5 * speed, base + 0.5 * speed_base
    return weights, base


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 12_000,
    max_features: int = 4096, corpus: DataFrame | None = None,
) -> Model:
    """Count the character model over ``corpus`` (all of ``docs``), and learn a lexicon from labels.

    Of more than ``max_rows`` labelled rows those with the smallest hash of their id are used. Rows
    without an id or with a label other than 0 and 1 are left out; null and empty texts have no features. An id that
    several documents or labels have counts once for each of their pairs. Without toxic rows, every
    score is their smoothed share. The lexicon has at most ``max_features`` features, those that say most. Other columns are
    not read, whatever their names.
    """
    model = language_model(count_grams(docs if corpus is None else corpus, text_col))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)")
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "_id")  # at most max_rows rows of two columns

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(Restorer(model))
        for batch in batches:
            tallies = Counter(), Counter()
            for text, y in zip(batch["text"], batch["_y"]):
                tallies[y].update(lookup.text(text))
            # A feature that no toxic row of the batch has may still be clean evidence.
            names = list(tallies[0].keys() | tallies[1].keys())
            yield pd.DataFrame({"f": names, "clean": [tallies[0][f] for f in names], "toxic": [tallies[1][f] for f in names]})

    counted = rows.select("text", "_y").mapInPandas(count, "f string, clean bigint, toxic bigint")
    total = {r._y: r["count"] for r in rows.groupBy("_y").count().collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    lexicon = (
        counted.groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= 4).withColumn("odds", odds).filter("odds >= 1.5")
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "f").limit(max_features)
    ).collect()
    features = {f: k for k, f in enumerate(specific([(r.f, r.toxic) for r in lexicon]))}

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(Restorer(model), features)
        for batch in batches:
            yield pd.DataFrame({"_id": batch["_id"], "_y": batch["_y"], "found": [sorted(lookup.text(t)) for t in batch["text"]]})

    found = rows.select("_id", "_y", "text").mapInPandas(find, "_id long, _y int, found array<int>").orderBy("_id").limit(max_rows).collect()
    weights, base = _weigh([r.found for r in found], np.array([r._y for r in found], float), len(features))
    seen = {r.f: (r.toxic, r.toxic + r.clean) for r in lexicon}
    hits = np.array([seen[f] for f in features], float).reshape(-1, 2)
    return Model(model, features, weights, base, alone(hits[:, 0], hits[:, 1]))


def score(text: Column | str, model: Model) -> Column:
    """Probability that a whole text is toxic; null counts as empty. A column expression: repeated rows get equal scores, a
    table without rows stays so, and no other column is read or added."""

    @F.pandas_udf("double")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lookup = model.lookup()
        for texts in batches:
            yield pd.Series([model.score(lookup.text(t)) for t in texts], dtype=float)

    return look(F.col(text) if isinstance(text, str) else text)
