"""Benchmark passages in documents by the q-gram lemma over diagonal bands (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, text_bytes

Q = 8  # characters (bytes of UTF-8) of a q-gram: one machine word
_BLANK = 32
# A short item is searched only if its normal form has so many words, or so many bytes; less stands everywhere.
SHORT_WORDS, SHORT_BYTES = 3, 20

# Normal form, byte by byte: A-Z in lower case; ASCII characters that are neither letters nor digits are blanks.
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[[b for b in range(128) if not chr(b).isalnum()]] = _BLANK


def normal(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(normalised bytes of all texts, each ended by one blank; start of each text plus the end)."""
    data, offsets = text_bytes(column)
    form = _FORM[data]
    blank = form == _BLANK
    keep = ~blank | ~np.r_[True, blank[:-1]]
    keep[offsets[1:] - 1] = True  # each text keeps its last separator
    return form[keep], np.r_[0, np.cumsum(keep)][offsets]


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at every place as a 64-bit number."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    wide = data.astype(np.uint64)
    for step in (1, 2, 4):
        wide = wide[:-step] | (wide[step:] << np.uint64(8 * step))
    return wide


def edit_budget(length: np.ndarray | int, rate: float):
    """Edits a passage of this many bytes may have."""
    return np.floor(np.asarray(length) * rate).astype(np.int64)


class PassageIndex:
    """The q-grams of one block of benchmark items, sorted, with a bit table in front of them."""

    TABLE_BITS = 22

    def __init__(self, ids: list[int | None], texts: list[str], rate: float, accept: float, min_chars: int = 0):
        data, offsets = normal(pa.array(texts, pa.string()))
        items = [data[a : b - 1] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        items = [x[1:] if len(x) and x[0] == _BLANK else x for x in items]
        items = [x[:-1] if len(x) and x[-1] == _BLANK else x for x in items]
        told = [len(x) >= min_chars or len(x) >= Q and (len(x) >= SHORT_BYTES or (x == _BLANK).sum() >= SHORT_WORDS - 1) for x in items]
        self.ids = pa.array([i for i, t in zip(ids, told, strict=True) if t], pa.int64())
        self.items = [x for x, t in zip(items, told, strict=True) if t]
        self.length = np.array([len(x) for x in self.items], np.int64)
        self.exact = self.length < min_chars
        self.edits, self.budget = (np.where(self.exact, 0, edit_budget(self.length, r)) for r in (rate, accept))
        # q-gram lemma: with e edits at least this many of the item's q-grams stay, on diagonals at most e apart.
        self.least = np.maximum(1, self.length - Q + 1 - Q * self.edits)
        self.half = np.maximum(1, self.edits)  # of a band
        self.longest = int(self.length.max(initial=0))
        codes = [grams(x) for x in self.items]
        gram = np.concatenate([np.zeros(0, np.uint64), *codes])
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(c)) for c in codes]])
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.place = gram[order], item[order], place[order]
        self.values, self.first = np.unique(self.gram, return_index=True)
        self.first = np.r_[self.first, len(self.gram)]
        self.table = np.zeros(1 << self.TABLE_BITS, bool)
        self.table[self._slot(self.values)] = True

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.TABLE_BITS)).astype(np.int64)

    def regions(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, lowest diagonal) of every band that shares enough q-grams with its item.

        A diagonal is place in the data minus place in the item. Bands of twice the edit budget overlap by half, so
        the diagonals of one occurrence lie in one band.
        """
        codes = grams(data)
        at = np.flatnonzero(self.table[self._slot(codes)])
        which = np.searchsorted(self.values, codes[at])
        real = (which < len(self.values)) & (self.values[np.minimum(which, len(self.values) - 1)] == codes[at])
        at, which = at[real], which[real]
        times = self.first[which + 1] - self.first[which]
        row = np.repeat(self.first[which], times) + _counting(times)
        item, place = self.item[row], self.place[row]
        diagonal = np.repeat(at, times) - place + self.longest  # not negative
        out_item, out_low = [], []
        for shift in (0, 1):
            band = (diagonal + shift * self.half[item]) // (2 * self.half[item])
            key = band * len(self.ids) + item
            # First a count in a small table, where several bands may share a cell: it never counts too few.
            cell = self._slot(key.astype(np.uint64))
            few = np.bincount(cell, minlength=1 << self.TABLE_BITS)[cell] < self.least[item]
            # A place of the item counts once in a band, however often the data repeat its q-gram there.
            cells = np.unique(key[~few] * (self.longest + 1) + place[~few]) // (self.longest + 1)
            keys, count = np.unique(cells, return_counts=True)
            of = keys % len(self.ids)
            enough = count >= self.least[of]
            out_item.append(of[enough])
            out_low.append(((keys // len(self.ids)) * 2 * self.half[of] - shift * self.half[of] - self.longest)[enough])
        return np.concatenate(out_item), np.concatenate(out_low)

    def verify(self, data: np.ndarray, item: int, low: int, begin: int, end: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the item's best alignment in the band from diagonal ``low`` on, if it is accepted.

        Banded dynamic programming over the item's characters; the start and end inside [begin, end) are free.
        """
        pattern, budget = self.items[item], int(self.budget[item])
        left = max(begin, low - budget)
        right = min(end, low + 2 * int(self.half[item]) + len(pattern) + budget)
        if self.exact[item]:
            return self._words(data, pattern, left, right, begin, end)
        whole = data[left:right].tobytes().find(pattern.tobytes())
        if whole >= 0:  # no alignment is better than an exact one
            return 0, left + whole, left + whole + len(pattern)
        low -= budget
        size = 2 * int(self.half[item]) + 2 * budget + 1
        lane = np.arange(size)
        places = low + lane  # place in the data of the cell before row 0
        far = 1 << 20
        cost = np.where((places >= begin) & (places <= end), 0, far)
        origin = places.copy()
        for i, char in enumerate(pattern.tolist()):
            here = low + i + lane  # data place compared in row i of each lane
            inside = (here >= begin) & (here < end)
            same = np.zeros(size, bool)
            same[inside] = data[here[inside]] == char
            # From the same lane: match or replace. From the lane above: the item's character is missing in the data.
            straight = np.where(inside, cost + ~same, far)
            above = np.r_[cost[1:] + 1, far]
            step = np.minimum(straight, above)
            source = np.where(straight <= above, origin, np.r_[origin[1:], 0])
            # From lanes below in the same row: extra characters in the data.
            slope = step - lane
            best = np.minimum.accumulate(slope)
            reach = np.maximum.accumulate(np.where(slope == best, lane, 0))
            cost, origin = best + lane, source[reach]
            if i % 16 == 0 and cost.min() > budget:
                return None
        stop = low + len(pattern) + lane
        cost = np.where((stop <= end) & (stop >= begin), cost, far)
        k = int(np.argmin(cost))
        return (int(cost[k]), int(origin[k]), int(stop[k])) if cost[k] <= budget else None

    @staticmethod
    def _words(data: np.ndarray, pattern: np.ndarray, left: int, right: int, begin: int, end: int) -> tuple[int, int, int] | None:
        """The first place in [left, right) where the whole words of a short item stand."""
        window, wanted, at = data[left:right].tobytes(), pattern.tobytes(), -1
        while (at := window.find(wanted, at + 1)) >= 0:
            start, stop = left + at, left + at + len(pattern)
            if (start == begin or data[start - 1] == _BLANK) and (stop >= end or data[stop] == _BLANK):
                return 0, start, stop
        return None

    def search(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, edits, start, end) of the best occurrence of every item in every text."""
        data, offsets = normal(column)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for item, low in sorted(set(zip(*(x.tolist() for x in self.regions(data)), strict=True))):
            # A band may touch the end of one text and the start of the next.
            first = int(np.searchsorted(offsets, max(low - int(self.budget[item]), 0), "right")) - 1
            last = int(np.searchsorted(offsets, low + int(2 * self.half[item] + self.length[item] + self.budget[item]), "left"))
            for doc in range(max(0, first), min(last, len(offsets) - 1)):
                found = self.verify(data, item, low, int(offsets[doc]), int(offsets[doc + 1]) - 1)
                if found:
                    edits, start, end = found
                    place = (edits, start - int(offsets[doc]), end - int(offsets[doc]))
                    best[doc, item] = min(best.get((doc, item), place), place)
        return [(doc, item, *place) for (doc, item), place in sorted(best.items())]


def _counting(times: np.ndarray) -> np.ndarray:
    """0, 1, ... times[0]-1, 0, 1, ... times[1]-1, and so on."""
    ends = np.cumsum(times)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - times, times)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.1,
    accept: float = 0.2,
    min_chars: int = 40,
    block_bytes: int = 1_000_000,
    text: str = "text",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, edits, start, end): the best occurrence of each benchmark item in each document.

    Texts are compared in a normal form (A-Z in lower case, other ASCII marks and white space as single blanks), in
    which start and end count bytes. A passage within ``rate`` edits per byte of the item is always found; one within
    ``accept`` is found if it still shares the q-grams of a band, as when whole words were replaced. Items are
    held in blocks of about ``block_bytes`` in every task; each block is one pass over the documents, so the benchmark
    may have any size and what a task holds is bounded. Items whose normal form is shorter than ``min_chars`` bytes must
    stand word for word, no edits; of these, items under ``Q`` bytes, or under both ``SHORT_BYTES`` and ``SHORT_WORDS``,
    stand everywhere and are skipped, like null ones. Null and empty documents hold nothing. Repeated rows and items come
    out once each; null ids are carried along; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, edits int, start bigint, end bigint"
    found = None
    for index in _blocks(benchmark, rate, accept, min_chars, block_bytes, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # about block_bytes of text at most

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for whole in batches:
                for batch in slices(whole, "text"):
                    hits = own.search(batch.column(1))
                    if hits:
                        doc, item, edits, start, end = (np.array(x) for x in zip(*hits, strict=True))
                        columns = [batch.column(0).take(pa.array(doc)), own.ids.take(pa.array(item)), pa.array(edits, pa.int32()), pa.array(start), pa.array(end)]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "edits", "start", "end"])

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _blocks(
    benchmark: DataFrame, rate: float, accept: float, min_chars: int, block_bytes: int, item_text: str
) -> Iterator[PassageIndex]:
    """Indexes over the items, block by block, in the order of their ids."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text")
    ).filter(F.octet_length("text") >= Q).dropDuplicates()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    if n > 1:
        items = stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark")
    for k in range(n):
        rows = (items.filter(F.col("block") == k) if n > 1 else items).orderBy("item_id", "text").collect()
        yield PassageIndex([r["item_id"] for r in rows], [r["text"] for r in rows], rate, accept, min_chars)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; see ``find_passages``.

    The test is made where the row lies, so nothing is shuffled; a row is kept or dropped by its own text alone.
    """
    at = docs.columns.index(text)
    kept = docs.withColumn(text, F.col(text).cast("string"))
    settings = {"rate": 0.1, "accept": 0.2, "min_chars": 40, "block_bytes": 1_000_000, "item_text": "text", **options}
    for index in _blocks(benchmark, **settings):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def test(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, whole.schema.names[at]):
                    clean = np.ones(batch.num_rows, bool)
                    clean[[doc for doc, *_ in shared.value.search(batch.column(at))]] = False
                    yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(test, kept.schema)
    return kept
