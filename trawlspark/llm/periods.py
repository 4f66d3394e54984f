"""Periodic runs of words, found on a grid per period by longest common extensions (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Words, let, slices

# A perfect difference set; each difference from 1 to 30 modulo 31 is that of just one pair.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
# Grid points that are looked at together.
POINTS = 1 << 20
# Per difference, the member of the cover that lies on the left; a member itself for difference 0.
_LEFT = np.zeros(MODULUS, np.int64)
for _a in COVER:
    for _b in COVER:
        if _a != _b:
            _LEFT[(_b - _a) % MODULUS] = _a


class Extensions:
    """How far the words after two places of one text agree, for many pairs of places at once.

    ``x`` numbers the words of some texts; each text ends with a number of its own that stands nowhere else, so no two
    suffixes are equal and no extension leaves its text. Only suffixes that begin at places of the difference cover are
    sorted: by text, by words, then by doubling over blocks of ``MODULUS`` words. Whatever two places are, fewer than
    ``MODULUS`` words after them lie two sorted places, and their common prefix is a range minimum of the common prefixes
    of neighbours in the order.
    """

    def __init__(self, x: np.ndarray, text: np.ndarray, symbols: int):
        self.x = np.r_[x, np.zeros(MODULUS, np.int64)]
        first = np.zeros(MODULUS, np.int64)
        places = []
        for c in COVER:
            first[c] = sum(map(len, places))
            places.append(np.arange(c, len(x), MODULUS))
        self.first, place = first, np.concatenate(places)
        self.rank = np.zeros(len(place), np.int64)
        live = self._split(np.arange(len(place)), (text[place] * symbols + x[place]) * symbols + self.x[place + 1])
        for t in range(2, MODULUS, 2):
            if not len(live):
                break
            more = self.x[place[live] + t + 1] if t + 1 < MODULUS else 0
            live = self._split(live, self.x[place[live] + t] * symbols + more)
        levels = [self.rank.copy()]
        while len(live):
            live = self._split(live, self.rank[live + (1 << len(levels) - 1)])
            levels.append(self.rank.copy())
        order = np.empty_like(self.rank)
        order[self.rank] = np.arange(len(order))
        self.tables = [self._neighbours(place, order, levels, text)]

    def _split(self, live: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Parts groups of equal rank by a key; returns those that still share their rank. Ranks are places in order."""
        order = np.lexsort((key, self.rank[live]))
        live, key = live[order], key[order]
        rank, at = self.rank[live], np.arange(len(live))
        group = np.r_[True, rank[1:] != rank[:-1]][: len(live)]
        new = group | np.r_[True, key[1:] != key[:-1]][: len(live)]
        start, own = (np.maximum.accumulate(np.where(f, at, 0)) for f in (group, new))
        self.rank[live] = rank + own - start
        return np.sort(live[~(new & np.r_[new[1:], True][: len(live)])])

    def _neighbours(self, place: np.ndarray, order: np.ndarray, levels: list[np.ndarray], text: np.ndarray) -> np.ndarray:
        """Common words of each sorted suffix and the one before it; 0 at the first of a text."""
        out = np.zeros(len(order), np.int64)
        at = np.flatnonzero(np.r_[False, text[place[order[1:]]] == text[place[order[:-1]]]][: len(order)])
        a, b = order[at - 1], order[at]
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][a] == levels[level][b]
            out[at[same]] += MODULUS << level
            a, b = a + (same << level), b + (same << level)
        a, b = place[a], place[b]
        for t in range(MODULUS):
            same = self.x[a + t] == self.x[b + t]
            at, a, b = at[same], a[same], b[same]
            if not len(at):
                break
            out[at] += 1
        return out

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest common prefix of the neighbours low + 1 .. high, from a sparse table that grows as it is asked."""
        width = high - low
        level = np.frexp(width.astype(np.float64))[1] - 1
        while len(self.tables) <= level.max(initial=0):
            last, half = self.tables[-1], 1 << len(self.tables) - 1
            self.tables.append(np.minimum(last[:-half], last[half:]))
        out = np.empty(len(low), np.int64)
        for n in np.unique(level):
            of = np.flatnonzero(level == n)
            out[of] = np.minimum(self.tables[n][low[of] + 1], self.tables[n][high[of] + 1 - (1 << n)])
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from the places ``i`` and ``j`` on; i != j, in one text each."""
        steps = (_LEFT[(j - i) % MODULUS] - i) % MODULUS  # words up to two sorted places
        out, reached, live = steps.copy(), np.ones(len(i), bool), np.arange(len(i))
        for t in range(MODULUS):
            live = live[steps[live] > t]
            if not len(live):
                break
            same = self.x[i[live] + t] == self.x[j[live] + t]
            stop = live[~same]
            out[stop], reached[stop] = t, False
            live = live[same]
        at = np.flatnonzero(reached)
        ends = [p[at] + steps[at] for p in (i, j)]
        a, b = (self.rank[self.first[p % MODULUS] + p // MODULUS] for p in ends)
        out[at] += self._least(np.minimum(a, b), np.maximum(a, b))
        return out


def _counting(times: np.ndarray) -> np.ndarray:
    """0, 1, ... times[0]-1, 0, 1, ... times[1]-1, and so on."""
    ends = np.cumsum(times)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - times, times)


def runs_of(code: np.ndarray, doc: np.ndarray, counts: np.ndarray, symbols: int, least: int, times: int) -> np.ndarray:
    """Rows (text, start, length, period) of all runs in texts given as word numbers, by text, start and period.

    A run of period p has ``least`` words and ``times`` periods at least, so the words equal to the one p later make a
    stretch of max(least, times * p) - p or more, which holds a point of the grid of that width. Points whose two words
    agree are extended in both directions. Stretches of a multiple of a run's period have the run's ends; there the
    smallest period stays.
    """
    none = np.zeros((0, 4), np.int64)
    own = np.flatnonzero(counts >= max(least, times))
    if not len(own):
        return none
    # Each text between two numbers that stand nowhere else; the same from the end.
    begin = np.r_[0, np.cumsum(counts + 1)][:-1] + 1
    x = np.empty(len(code) + len(counts) + 1, np.int64)
    owner = np.empty(len(x), np.int64)
    x[np.r_[0, begin + counts]] = symbols + np.arange(len(counts) + 1)
    owner[np.r_[0, begin + counts]] = np.r_[0, np.arange(len(counts))]
    at = np.arange(len(code)) + doc + 1
    x[at], owner[at] = code, doc
    symbols += len(counts) + 1

    n_periods = counts[own] // times
    pair_doc = np.repeat(own, n_periods)
    period = _counting(n_periods) + 1
    width = np.maximum(least - period, (times - 1) * period)
    n_points = -(-(counts[pair_doc] - period) // width)
    upto = np.r_[0, np.cumsum(n_points)]
    hits = []
    low = 0
    while low < len(period):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + POINTS, "right")) - 1)
        pair = np.repeat(np.arange(low, high), n_points[low:high])
        point = begin[pair_doc[pair]] + _counting(n_points[low:high]) * width[pair]
        same = x[point] == x[point + period[pair]]
        hits.append((point[same], pair[same]))
        low = high
    point, pair = (np.concatenate(c) for c in zip(*hits, strict=True))
    if not len(point):
        return none
    ahead, back = Extensions(x, owner, symbols), Extensions(x[::-1], owner[::-1], symbols)
    found = []
    for low in range(0, len(point), POINTS):
        i, of = point[low : low + POINTS], pair[low : low + POINTS]
        p = period[of]
        left = back.common(len(x) - i, len(x) - i - p)  # the words before both places
        length = left + ahead.common(i, i + p) + p
        start = i - left - begin[pair_doc[of]]
        long = length >= np.maximum(least, times * p)
        found.append(np.stack([pair_doc[of], start, length, p], axis=1)[long])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)][: len(rows)]]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _collapsed(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, one blank between them, cut out of the bytes of the texts."""
    doc = words.doc[kept]
    data = words.data.copy()
    step = np.zeros(len(data) + 1, np.int8)
    step[words.start[kept]] += 1
    step[words.end[kept]] -= 1
    inner = np.r_[doc[1:] == doc[:-1], False][: len(doc)]
    blank = words.end[kept][inner]  # a text's last byte is no word's, so a byte follows every word
    taken = np.cumsum(step[:-1]).astype(bool)
    taken[blank] = True
    data[blank] = 32
    sizes = np.bincount(doc, words.end[kept] - words.start[kept] + inner, minlength=words.n).astype(np.int64)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[taken])]
    return pa.LargeStringArray.from_buffers(words.n, buffers[1], buffers[2]).cast(pa.string())


def find_runs(docs: DataFrame, least: int = 24, times: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of every row's words, and the text with one period of each.

    ``runs`` holds (start, length, period) by start, then period. A run is a stretch of words with smallest period q, at
    least ``least`` words and ``times`` periods long, which no neighbouring word extends. ``collapsed`` has the words,
    joined by one blank, that no run contains after its first q words. Null and empty texts have no words, no runs and
    an empty ``collapsed``. Repeated rows, ties and null ids come out as they are; other columns are not read; an empty
    table gives an empty result. A text is one row of one task: its memory grows with its words, not with its runs'
    periods (grid points are made ``POINTS`` at a time, and only those whose words agree are held).
    """
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column(1), lower=False)
                code, symbols = words.codes()
                rows = runs_of(code, words.doc, words.counts, symbols, least, times)
                first = words.first[rows[:, 0]]
                drop = np.zeros(len(code) + 1, np.int64)
                np.add.at(drop, first + rows[:, 1] + rows[:, 3], 1)
                np.add.at(drop, first + rows[:, 1] + rows[:, 2], -1)
                kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
                ends = np.searchsorted(rows[:, 0], np.arange(batch.num_rows + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], fields=list(kind))
                columns = [
                    batch.column(0), pa.array(words.counts.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), values), _collapsed(words, kept),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(scan, schema)


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text, whose end repeats itself where crc32 of the decimal id is a multiple of 10; a null id changes nothing."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        tail = F.transform(F.sequence(F.lit(0), (n - a - 1).cast("int")), lambda i: F.get(words, (a + i % p).cast("int")))
        whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), tail)
        return F.when(n > 0, F.array_join(whole, " ")).otherwise(text)

    return F.when((h % 10 == 0) & text.isNotNull(), let(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), repeated)).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """Per row of ``find_runs``: number of runs, the one with most periods, and digests of the runs and of ``collapsed``.

    The run with the greatest exact length / period is named (first by start, then period), or nulls if there is none.
    """
    runs = F.col("runs")
    best = F.reduce(
        F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0))),
        F.get(runs, 0),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("b", best).select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"),
        *[F.col(f"b.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("b.length") / F.col("b.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
