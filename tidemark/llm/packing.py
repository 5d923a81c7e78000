"""Best-fit packing of token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so their histogram has a bounded number of rows
whatever the number of documents, and it is all the driver needs:

1. Large lengths are put into groups of equal count, and each is rounded up to its group's largest.
2. Configurations (how many pieces of each group share a sequence) are chosen for these few sizes.
3. Actual pieces take the places of their group, largest first, which leaves room behind.
4. Small lengths go best-fit into the room left, then into new sequences.

Sequences that look alike are kept as one run with a count, so the plan stays a bounded table. Each
piece then finds its place from its length and its number among the pieces of that length, which
Spark counts in slices.
"""

from __future__ import annotations

import base64
import re
import sys
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words whose ids a worker remembers before it forgets all and starts anew.
REMEMBERED = 400_000
#: Rows of one slice in which pieces of a length are numbered, and slices in one block.
SLICE_ROWS, BLOCK_SLICES = 500, 1000


class ByteBpe:
    """Ids of a byte-level BPE vocabulary, the same as its ``tokenizers`` file gives.

    Such a tokenizer splits a text into words first and merges inside each word only, so the ids
    of a word are remembered. Texts with other characters than those of ``PLAIN`` go to the
    tokenizer itself, as do texts with a special token.
    """

    #: Characters on which the word pattern below agrees with the tokenizer's own.
    PLAIN = re.compile(r"[\t-\r -~¡-©«-±´¶-¸»¿-ÿ]*")
    WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")

    def __init__(self, path: str, ranks_path: str | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = None
        if ranks_path:
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.quick = tiktoken.Encoding("byte_bpe", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.quick is None or not self.PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = self.WORDS.findall(text)
        known = self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = np.array(self.quick.encode_ordinary(w), "<u4").tobytes()
            return b"".join(map(known.__getitem__, words))


_LOADED: dict[tuple, ByteBpe] = {}


def pieces(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """``id, piece, start, length, ids`` (little-endian unsigned 32-bit) of each document's tokens.

    A document is the ids of its whole text and ``end_id``; null is taken as empty. Documents over
    ``capacity`` are cut so that all pieces but the first are full. Repeated rows give their
    pieces again; ids may be null; other columns are not looked at.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if (tokenizer, ranks) not in _LOADED:
            _LOADED[tokenizer, ranks] = ByteBpe(tokenizer, ranks)
        bpe, last = _LOADED[tokenizer, ranks], np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            for i, text in zip(batch["id"], batch["text"]):
                ids = bpe.encode(text or "") + last
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                out += [(i, k, a, b - a, ids[4 * a : 4 * b]) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids"])

    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    made = texts.mapInPandas(cut, "id string, piece int, start bigint, length bigint, ids binary")
    return made.select(F.col("id").cast("bigint").alias(id_col), "piece", "start", "length", "ids")


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences for few sizes: ``(how many of each size, how often)``.

    Again and again the largest size left gets the companions that fill its sequence best (an exact
    bounded knapsack over what is left), and that configuration is used as often as its
    members allow. Each use exhausts a size or leaves too few of one, so there are few.
    """
    left, out = list(counts), []
    while any(left):
        top = next(k for k, n in enumerate(left) if n)
        reach: dict[int, tuple[int, ...]] = {sizes[top]: (top,)}
        for k in range(top, len(sizes)):
            for filled, members in sorted(reach.items()):
                room = left[k] - members.count(k)
                more, now = filled + sizes[k], members + (k,)
                while more <= capacity and room > 0:
                    if more not in reach or len(reach[more]) > len(now):
                        reach[more] = now
                    more, now, room = more + sizes[k], now + (k,), room - 1
        members = reach[max(reach)]
        config = tuple(members.count(k) for k in range(len(sizes)))
        times = min(left[k] // n for k, n in enumerate(config) if n)
        out.append((config, times))
        left = [n - times * c for n, c in zip(left, config)]
    return out


def plan(histogram: dict[int, int], capacity: int = 1024, groups: int = 341, large: float = 1 / 3) -> list[tuple[int, int, int, int, int, int]]:
    """``length, low, high, sequence, offset, step`` for numbers ``low <= k < high`` of a length.

    Number ``k`` goes to sequence ``sequence + (k - low) // step`` at ``offset + (k - low) % step * length``.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    taken = dict.fromkeys(histogram, 0)
    sequences = 0

    def place(length: int, n: int, first: int, offset: int, step: int) -> None:
        out.append((length, taken[length], taken[length] + n, first, offset, step))
        taken[length] += n

    # Runs of sequences that look alike, by room left: (room, first sequence, how many).
    runs: list[tuple[int, int, int]] = []
    big = sorted((x for x in histogram if x > capacity * large and histogram[x]), reverse=True)
    full = [x for x in big if x == capacity]
    for x in full:
        place(x, histogram[x], 0, 0, 1)
        sequences = histogram[x]
    big = [x for x in big if x < capacity]
    total = sum(histogram[x] for x in big)
    # Groups of equal count: the places of group g are the pieces g * width to (g + 1) * width - 1, largest first.
    width = max(1, -(-total // groups))
    flow = [(x, histogram[x]) for x in big]
    members: list[list[list[int]]] = []
    while flow:
        room, mine = width, []
        while flow and room:
            x, n = flow[0]
            use = min(n, room)
            mine.append([x, use])
            room -= use
            flow[0] = (x, n - use)
            if flow[0][1] == 0:
                flow.pop(0)
        members.append(mine)
    sizes = [m[0][0] for m in members]
    counts = [sum(n for _, n in m) for m in members]
    for config, times in _configurations(sizes, counts, capacity) if members else []:
        slots = [g for g, c in enumerate(config) for _ in range(c)]
        # Every slot takes the next pieces of its group; where an actual length changes, a new run starts.
        done = 0
        takes = []
        for g in slots:
            need, got = times, []
            while need:
                x, n = members[g][0]
                use = min(n, need)
                got.append((x, use))
                members[g][0][1] -= use
                if members[g][0][1] == 0:
                    members[g].pop(0)
                need -= use
            takes.append(got)
        at = [0] * len(slots)
        while done < times:
            n = min(takes[s][at[s]][1] for s in range(len(slots)))
            offset = 0
            for s in range(len(slots)):
                x, have = takes[s][at[s]]
                place(x, n, sequences + done, offset, 1)
                offset += x
                takes[s][at[s]] = (x, have - n)
                if have == n:
                    at[s] += 1
            if offset < capacity:
                insort(runs, (capacity - offset, sequences + done, n))
            done += n
        sequences += times
    for x in sorted((x for x in histogram if x <= capacity * large and histogram[x]), reverse=True):
        n = histogram[x]
        while n:
            k = bisect_left(runs, (x, -1, -1))
            if k == len(runs):
                each = capacity // x
                many = -(-n // each)
                runs.append((capacity, sequences, many))
                sequences += many
                k = len(runs) - 1
            room, first, many = runs.pop(k)
            each = min(room // x, n)
            use = min(many, n // each)
            place(x, use * each, first, capacity - room, each)
            n -= use * each
            if use < many:
                insort(runs, (room, first + use, many - use))
            if room - each * x:
                insort(runs, (room - each * x, first, use))
    return out


def fewest(histogram: dict[int, int], capacity: int = 1024) -> list[tuple[int, int, int, int, int, int]]:
    """The plan with the fewest sequences of several bounds between large and small lengths."""
    plans = [plan(histogram, capacity, large=x) for x in (1 / 4, 1 / 3, 2 / 5, 1 / 2)]
    return min(plans, key=lambda p: max((s - (-(high - low) // step) for _, low, high, s, _, step in p), default=0))


def pack(made: DataFrame, capacity: int = 1024, order: tuple[str, ...] = (), length_col: str = "length") -> DataFrame:
    """``made`` with ``sequence_id, offset``: pieces side by side in sequences of at most ``capacity``.

    ``order`` names columns that tell pieces apart; equal rows may trade places. Lengths must be
    from 1 to ``capacity``. An empty table gives an empty result. Columns of the two added
    names are replaced.
    """
    spark = made.sparkSession
    made = stored(made.drop("sequence_id", "offset"), "pieces")
    columns = [f"column_{i}" for i in range(len(made.columns))]  # none clashes with those added here
    keys = [F.col(columns[made.columns.index(c)]) for c in order or made.columns]
    length = F.col(f"`{length_col}`").cast("bigint").alias("_length")
    sized = made.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(made.columns, columns)], length)
    # One row per length: bounded by the capacity, like all that follows from it.
    histogram = {r._length: r.n for r in sized.groupBy("_length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= (x or 0) <= capacity for x in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    slices = spark.createDataFrame([(x, -(-n // SLICE_ROWS)) for x, n in histogram.items()], "_length bigint, _slices bigint")
    places = spark.createDataFrame(
        fewest(histogram, capacity), "_length bigint, _low bigint, _high bigint, _sequence bigint, _offset bigint, _step bigint"
    )
    sliced = sized.join(F.broadcast(slices), "_length").withColumn("_slice", F.pmod(F.xxhash64(*keys), "_slices")).drop("_slices")
    counts = stored(sliced.groupBy("_length", "_slice").agg(F.count("*").alias("_n")), "piece-counts")
    # Pieces ahead of a slice: those of earlier blocks of slices, and of earlier slices in its block.
    counts = counts.withColumn("_block", F.expr(f"_slice div {BLOCK_SLICES}"))
    blocks = counts.groupBy("_length", "_block").agg(F.sum("_n").alias("_m"))
    blocks = blocks.withColumn("_above", F.sum("_m").over(Window.partitionBy("_length").orderBy("_block")) - F.col("_m")).drop("_m")
    within = Window.partitionBy("_length", "_block").orderBy("_slice")
    ahead = counts.withColumn("_inside", F.sum("_n").over(within) - F.col("_n")).join(blocks, ["_length", "_block"])
    ahead = stored(ahead.select("_length", "_slice", (F.col("_above") + F.col("_inside")).alias("_before")), "piece-offsets")
    inside = Window.partitionBy("_length", "_slice").orderBy(*keys)
    numbered = sliced.withColumn("_k", F.row_number().over(inside) - 1).join(ahead, ["_length", "_slice"]).withColumn("_k", F.col("_k") + F.col("_before"))
    near = F.broadcast(places.withColumnRenamed("_length", "_size"))
    placed = numbered.join(near, (F.col("_length") == F.col("_size")) & (F.col("_k") >= F.col("_low")) & (F.col("_k") < F.col("_high")))
    return placed.select(
        *[F.col(x).alias(c) for c, x in zip(made.columns, columns)],
        F.expr("_sequence + (_k - _low) div _step").alias("sequence_id"),
        F.expr("_offset + (_k - _low) % _step * _length").alias("offset"),
    )
