"""Helpers shared by the operators of this folder: stored steps, and words of many texts at once as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored as stored

# White space between words, as Java and Python patterns read it; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

_U64 = np.uint64
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda inside ``body`` uses it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batch: pa.RecordBatch, text: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text each, whole rows always; a longer text comes alone."""
    column = batch.column(batch.schema.get_field_index(text))
    offsets = np.cumsum(np.r_[0, _lengths(column)])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def _lengths(column: pa.Array) -> np.ndarray:
    offset_type = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], offset_type)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(raw).astype(np.int64)
    if column.null_count:
        lengths[np.asarray(column.is_null())] = 0
    return lengths


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, each followed by one line feed; start of each text plus the end); null is empty."""
    joined = "\n".join(t or "" for t in column.to_pylist()) + "\n"
    data = np.frombuffer(joined.encode(), np.uint8)
    return data, np.cumsum(np.r_[0, _lengths(column) + 1])


class Words:
    """Words of many texts: byte start and end, and number of the text, of every word in order.

    ``data`` has A-Z in lower case unless ``lower`` is false.
    """

    def __init__(self, column: pa.Array, lower: bool = True):
        data, self.offsets = text_bytes(column)
        self.data = _LOWER[data] if lower else data
        self.space = _SPACES[self.data]
        edge = np.diff(np.r_[True, self.space].view(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        self.n = len(column)
        self.counts = np.bincount(self.doc, minlength=self.n)
        self.first = np.cumsum(np.r_[0, self.counts])  # of each text, plus the end

    def codes(self) -> tuple[np.ndarray, int]:
        """(a number of each word, the same for equal words; how many numbers there are)."""
        offsets = np.r_[0, np.cumsum(self.end - self.start)].astype(np.int64)
        letters = np.ascontiguousarray(self.data[~self.space])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        return np.asarray(words.indices).astype(np.int64), len(words.dictionary)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial over its bytes from prefix sums, then mixed."""
        power, inverse = _powers(len(self.data))
        sums = np.r_[_U64(0), np.cumsum(_BYTES[self.data] * power[: len(self.data)], dtype=_U64)]
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(_U64))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all runs of ``k`` words inside one text, number of each run's first word)."""
        h = self.hashes()
        if len(h) < k:
            return h[:0], np.zeros(0, np.int64)
        n = len(h) - k + 1
        out = h[:n].copy()
        for j in range(1, k):
            out = out * _ODD + h[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return mix(out[at]), at


_ODD = _U64(0x9E3779B97F4A7C15)  # fixed value: odd, so it has an inverse modulo 2**64
_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, _U64)
_CACHE: list[np.ndarray] = [np.ones(0, _U64), np.ones(0, _U64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_CACHE[0]) < n:
        for k, base in enumerate((int(_ODD), pow(int(_ODD), -1, 2**64))):
            row = np.full(n, base, _U64)
            row[0] = 1
            _CACHE[k] = np.cumprod(row, dtype=_U64)
    return _CACHE


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix64 finish; its three constants are fixed values)."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))
