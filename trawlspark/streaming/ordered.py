"""Rules that need a key's rows in time order, on streams: rows wait in state and timers bring them up.

``transformWithState`` keeps the rows of each key in sorted runs, cut into parts, and one timer per key for the next row
that may go. When the watermark has passed it, the runs are merged up to the watermark, so a rule sees the rows of a key in
order whatever trigger brought them. A task holds a run while it is sorted and one part of each run while they are merged,
never all rows of a key. Parts go when their rows have gone.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta
from heapq import heappop, heappush
from itertools import islice
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.frontier import VISIT_TTL

# Timers and large state need this store of Spark; set it on the session before the stream starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
RUN, SMALL, PARTS = 16384, 32, 64  # rows that are sorted together, that are one entry of the state; entries of a longer run
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
_MICROSECOND = timedelta(microseconds=1)


def micros(at: datetime) -> int:
    return (at.astimezone(UTC) - _EPOCH) // _MICROSECOND


def _turn(row: tuple, ts: int, seq: int) -> tuple:
    return row[ts], row[seq] is not None, row[seq]


class InOrder(StatefulProcessor):
    """Rows (key, ts, seq, …) of a key, given to ``step`` in the order of ts and seq once the watermark has passed them.

    Per key there is what the rule remembers (``carry``), the timer that is set, and where each run stands: its number, its
    next part, how many parts it has, and the time of its next row.
    """

    def __init__(self, schema: T.StructType):
        self.fields = [f.name for f in schema.fields]
        self.schema = schema
        self.ts, self.seq = self.fields.index("ts"), self.fields.index("seq")
        self.out = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        run = "run int, part int, parts int, us bigint"
        self.book = handle.getValueState("book", f"carry bigint, timer bigint, runs array<struct<{run}>>")
        entry = T.StructType([T.StructField("rows", T.ArrayType(self.schema))])
        self.parts = handle.getMapState("parts", "run int, part int", entry)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        carry, timer, runs = self._known()
        due = None
        while taken := list(islice(rows, RUN)):
            taken = sorted((tuple(r[f] for f in self.fields) for r in taken), key=lambda r: _turn(r, self.ts, self.seq))
            number = runs[-1][0] + 1 if runs else 0
            size = SMALL if len(taken) <= SMALL else max(1, len(taken) // PARTS)
            for part, at in enumerate(range(0, len(taken), size)):
                self.parts.updateValue((number, part), (taken[at : at + size],))
            us = micros(taken[0][self.ts])
            runs.append((number, 0, -(-len(taken) // size), us))
            opens = _ms(self.opens(us, carry))
            due = opens if due is None else min(due, opens)
        self._note(carry, timer, runs, due)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        ms, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        carry, timer, runs = self._known()
        timer = None if timer is None or timer <= ms else timer
        closed = sorted(runs, key=lambda r: -r[3])  # the run with the next row last
        heap: list[tuple] = []  # (turn, run, parts, next part, rows, place) of the runs that are read
        due = None
        while closed or heap:
            while closed and (not heap or closed[-1][3] <= micros(heap[0][0][0])):
                number, part, parts, us = closed.pop()
                if us // 1000 > now:  # no row of it is due, and none of the runs after it
                    closed.append((number, part, parts, us))
                    break
                self._read(heap, number, part, parts)
            if not heap:
                due = _ms(self.opens(closed[-1][3], carry))
                break
            turn, number, parts, part, rows, place = heap[0]
            us = micros(turn[0])
            at = self.opens(us, carry)
            if at > now * 1000:
                due = _ms(at)
                break
            heappop(heap)
            carry, more = self.step(us, carry)
            yield Row(**dict(zip(self.out.names, (*rows[place], *more), strict=True)))
            if place + 1 < len(rows):
                heappush(heap, (_turn(rows[place + 1], self.ts, self.seq), number, parts, part, rows, place + 1))
            else:
                self.parts.removeKey((number, part))
                if part + 1 < parts:
                    self._read(heap, number, part + 1, parts)
        for turn, number, parts, part, rows, place in heap:
            if place:
                self.parts.updateValue((number, part), (rows[place:],))
            closed.append((number, part, parts, micros(turn[0])))
        if carry is not None:
            ends = _ms(self.forgets(carry))
            if ends <= now:
                carry = None  # no row to come can meet it
            else:
                due = ends if due is None else min(due, ends)
        self._note(carry, timer, sorted(closed), due)

    def _read(self, heap: list[tuple], number: int, part: int, parts: int) -> None:
        rows = [tuple(r) for r in self.parts.getValue((number, part))[0]]
        heappush(heap, (_turn(rows[0], self.ts, self.seq), number, parts, part, rows, 0))

    def _known(self) -> tuple[int | None, int | None, list[tuple[int, int, int, int]]]:
        known = self.book.get()
        return (known[0], known[1], [tuple(r) for r in known[2]]) if known else (None, None, [])

    def _note(self, carry: int | None, timer: int | None, runs: list[tuple], due: int | None) -> None:
        """Keep what is known of a key, with a timer for ``due`` if none that is set comes before it."""
        if due is not None and (timer is None or due < timer):
            self.handle.registerTimer(due)
            timer = due
        if carry is None and not runs:
            self.book.clear()
        else:
            self.book.update((carry, timer, runs))

    def step(self, us: int, carry: int | None) -> tuple[int, tuple]:
        """What the rule remembers after a row of time ``us``, and the columns it adds to the row."""
        raise NotImplementedError

    def opens(self, us: int, carry: int | None) -> int:
        """When a row of time ``us`` may come out if it is the next one; watermarks count milliseconds."""
        return us // 1000 * 1000

    def forgets(self, carry: int) -> int:
        """From when on what the rule remembers changes nothing."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class Pacer(InOrder):
    """Every row comes out once, at its own time or ``wait_us`` after the row of its key before it, whichever is later."""

    def __init__(self, schema: T.StructType, wait_us: int):
        super().__init__(schema)
        self.wait = wait_us
        self.out = T.StructType([*schema.fields, T.StructField("released_at", T.TimestampType())])

    def opens(self, us: int, carry: int | None) -> int:
        return us if carry is None else max(us, carry)

    def step(self, us: int, carry: int | None) -> tuple[int, tuple]:
        at = self.opens(us, carry)
        return at + self.wait, (_EPOCH + at * _MICROSECOND,)

    def forgets(self, carry: int) -> int:
        return carry  # a key may go at once


class Visits(InOrder):
    """Each row with ``fresh``: whether the last fresh row of its key is ``life_us`` ago or more; older visits are forgotten."""

    def __init__(self, schema: T.StructType, life_us: int):
        super().__init__(schema)
        self.life = life_us
        self.out = T.StructType([*schema.fields, T.StructField("fresh", T.BooleanType())])

    def step(self, us: int, carry: int | None) -> tuple[int, tuple]:
        fresh = carry is None or us - carry >= self.life
        return (us if fresh else carry), (fresh,)

    def forgets(self, carry: int) -> int:
        return carry + self.life


def _ms(us: int) -> int:
    return -(-us // 1000)


@contextmanager
def timer_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside use the state store that has timers; the session's own setting comes back after."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(df: DataFrame, key: str, rule: InOrder, delay: str) -> DataFrame:
    return df.withWatermark("ts", delay).groupBy(key).transformWithState(rule, rule.out, "append", "EventTime")


def paced_stream(df: DataFrame, interval_s: float, key: str = "host", delay: str = "0 seconds") -> DataFrame:
    """Rows (key, ts, seq, …) with ``released_at``: each comes out once, at least the interval after the one before.

    Rows of a key queue in the order of ts and seq. One that may not go yet stays in state and comes out by itself once
    the watermark reaches its turn. ``delay`` is how long the watermark waits for rows out of order; Spark drops rows
    behind it, as with every watermark, and counts them in the query's progress. Start the stream inside ``timer_state``.
    """
    wait = round(interval_s * 1_000_000)
    if wait < 1000:
        raise ValueError("the interval must be a millisecond or more")
    return _run(df, key, Pacer(df.schema, wait), delay)


def expiring_visits(df: DataFrame, ttl: str = VISIT_TTL, key: str = "url", delay: str = "0 seconds") -> DataFrame:
    """Rows (key, ts, seq, …) with ``fresh``: the visit rule in time order over all triggers; a visit's state ends with its life.

    See ``paced_stream`` for ``delay`` and the start of the stream.
    """
    life = pd.Timedelta(ttl)
    return _run(df, key, Visits(df.schema, life // pd.Timedelta(microseconds=1)), delay)
