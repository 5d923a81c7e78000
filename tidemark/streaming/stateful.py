"""Sessions tracked with state of our own.

``session_window`` is the simpler tool; this shows the general form: a state per key that each batch
adds to, and timers in event time that end what is in it.

Rows do not meet by key. A first stage sums them up in cells of a millisecond, the grain of a watermark, and hands on
a cell when the watermark has passed it. Tasks join cells of a key that lie no more than the gap apart before they send
them: of a key with a third of all rows, a few spans per task reach the second stage.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Send these functions along with the job: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SPAN = "first_us bigint, last_us bigint, events bigint, total bigint, valued bigint"
_OUTPUT = f"name string, {_SPAN}"
_COLUMNS = ["first_us", "last_us", "events", "total", "valued"]

#: The grain of a watermark.
_GRAIN_US = 1000

#: First and last time, events, total of the values, events that have a value.
Span = tuple[int, int, int, int, int]


def _merge(spans: list[Span], gap_us: int) -> list[Span]:
    """Join spans that lie no more than the gap apart."""
    merged: list[Span] = []
    for span in sorted(spans):
        if merged and span[0] <= merged[-1][1] + gap_us:
            a, b, *sums = merged[-1]
            merged[-1] = (a, max(b, span[1]), *(x + y for x, y in zip(sums, span[2:])))
        else:
            merged.append(tuple(span))
    return merged


def _joined(cells: pd.DataFrame, gap_us: int) -> pd.DataFrame:
    """The same for the cells of many keys, whose times do not overlap."""
    codes, names = pd.factorize(cells["name"], use_na_sentinel=False)
    order = np.lexsort((cells["first_us"], codes))
    codes = codes[order]
    first, last, events, total, valued = (cells[c].to_numpy()[order] for c in _COLUMNS)
    opens = np.ones(len(codes), bool)
    opens[1:] = (codes[1:] != codes[:-1]) | (first[1:] > last[:-1] + gap_us)
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(codes)) - 1
    sums = [np.add.reduceat(c, starts) for c in (events, total, valued)]
    names = np.array([None if pd.isna(x) else x for x in names], dtype=object)
    return pd.DataFrame({"name": names[codes[starts]], **dict(zip(_COLUMNS, [first[starts], last[ends], *sums]))})


def _join_in_tasks(gap_us: int, rows: int = 200_000) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Join the cells that a task holds, so many at a time."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for cells in batches:
            held, n = [*held, cells], n + len(cells)
            if n >= rows:
                yield _joined(pd.concat(held), gap_us)
                held, n = [], 0
        if n:
            yield _joined(pd.concat(held), gap_us)

    return join


class _Sessions(StatefulProcessor):
    """Open sessions of a key as a list, in order of time; a timer for the first that may end."""

    def __init__(self, gap_us: int, cell_us: int):
        self.gap_us, self.cell_us = gap_us, cell_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _SPAN)

    def _ends(self, span: Span) -> int:
        """The watermark at which a session is over and all rows that could go on with it have been handed on."""
        end = span[1] + self.gap_us
        return max((end // self.cell_us + 1) * self.cell_us, -(-end // _GRAIN_US) * _GRAIN_US + _GRAIN_US)

    def _settle(self, key: tuple, held: list[Span], spans: list[Span], watermark_us: int) -> Iterator[pd.DataFrame]:
        done = [s for s in spans if self._ends(s) <= watermark_us]
        left = [s for s in spans if self._ends(s) > watermark_us]
        if left:
            self.open.put(left)
            self.handle.registerTimer(min(map(self._ends, left)) // 1000)
        elif held:
            self.open.clear()
        if done:
            yield pd.DataFrame({"name": pd.Series([key[0]] * len(done), dtype=object), **dict(zip(_COLUMNS, zip(*done)))})

    def _held(self) -> list[Span]:
        return [tuple(int(x) for x in row) for row in self.open.get()] if self.open.exists() else []

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        spans = [*held]
        for cells in rows:
            spans += [tuple(int(x) for x in row) for row in cells[_COLUMNS].itertuples(index=False)]
        yield from self._settle(key, held, _merge(spans, self.gap_us), timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        yield from self._settle(key, held, held, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def track_sessions(
    events: DataFrame, gap_seconds: int, delay: str, key_col: str = "user_id", time_col: str = "ts", value_col: str = "value", cell_seconds: float = 0.001
) -> DataFrame:
    """Sessions per key as they end: first and last time, events, total value.

    ``value_col`` is in cents. The watermark is set on the rows themselves. A null key is a key
    like any other; keys keep their type and every digit. A session without values has a
    null total. Rows without a time are in no session. A session is reported when the newest time, in whole milliseconds,
    less the delay has reached its end, or the end of the cell which holds that, if cells are wider. A cell is closed once the watermark has
    passed it, so the watermark waits a millisecond less: rows of its own millisecond are handed on as well.
    """
    cell_us = round(cell_seconds * 1_000_000)
    if not 0 < cell_us <= gap_seconds * 1_000_000 or cell_us % _GRAIN_US:
        raise ValueError("a cell must have whole milliseconds and must not be wider than the gap")
    waits = f"{delay} -1 milliseconds" if any(digit in delay for digit in "123456789") else delay
    kind = dict(events.dtypes)[key_col]
    cents = F.col(value_col).cast("bigint")
    us = F.unix_micros(time_col)
    rows = events.filter(F.col(time_col).isNotNull()).withWatermark(time_col, waits)
    # Keys travel as text and values without nulls: pandas would make floats of both.
    cells = rows.groupBy(F.window(time_col, f"{cell_us} microseconds"), F.col(key_col).cast("string").alias("name")).agg(
        F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count("*").alias("events"),
        F.coalesce(F.sum(cents), F.lit(0)).cast("bigint").alias("total"), F.count(cents).alias("valued"),
    )
    gap_us = gap_seconds * 1_000_000
    spans = cells.select("name", *_COLUMNS).mapInPandas(_join_in_tasks(gap_us), _OUTPUT)
    sessions = spans.groupBy("name").transformWithStateInPandas(_Sessions(gap_us, cell_us), _OUTPUT, "append", "EventTime")
    return sessions.select(
        F.col("name").cast(kind).alias(key_col),
        F.timestamp_micros("first_us").alias("session_start"),
        F.timestamp_micros("last_us").alias("session_end"),
        "events",
        F.when(F.col("valued") > 0, F.col("total") / F.lit(100.0)).alias("session_value"),
    )
