"""Tokens of two tokenizers over the same bytes, aligned by interval coalescing (operator 13)."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
_ENCODED = 65_536  # bytes of words handed to a tokenizer as one text
# Fixed values of UTF-8: the first bytes of characters that are neither white space nor U+2581; 0xC2, 0xE1 to 0xE3 and
# 0xEF begin some that are.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_WIDE2, _WIDE = np.zeros(256, bool), np.zeros(256, bool)
_WIDE2[0xC3:0xE0] = True
_WIDE[0xC3:0xE0] = _WIDE[0xE4:0xEE] = _WIDE[0xF0:0xF5] = True


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = count(256)
    return {chr(b if b in printable else next(spare)): b for b in range(256)}


class TwoTokenizers:
    """Both tokenizers, the bytes of every token, and the decimal ids with each separator that may follow."""

    def __init__(self, model_a: str, model_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(model_a))
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path(model_b))
        letters, vocabulary = _byte_letters(), self.a.get_vocab()
        self.size_a, self.size_b = max(vocabulary.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.parts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.length_a, self.length_b = (np.array([len(t) for t in b], np.int64) for b in (self.bytes_a, self.bytes_b))
        self.names = [f"{i}{end}" for size, ends in ((self.size_a, ",|"), (self.size_b, ",;")) for end in ends for i in range(size)]

    def encode(self, parts: pa.Array) -> tuple[list[Side], np.ndarray]:
        """(the ids of A and of B, whether both give back the bytes of each part).

        Each part begins with a blank, which B puts before a text itself. Parts that begin and end with visible characters
        are read by A many at a time, one after the other: no token crosses from one to the next.
        """
        raw = parts.to_pylist()
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
        data = np.r_[np.frombuffer(parts.buffers()[2] or b"", np.uint8), 32, 32]
        joined, lengths = _ends_visible(data, offsets[1:]) & _begins_visible(data, offsets[:-1] + 1), np.diff(offsets)
        own, alone = np.flatnonzero(joined), np.flatnonzero(~joined)
        ends = np.cumsum(lengths[own])
        group = np.flatnonzero(np.diff(np.r_[-1, ends // _ENCODED]))
        texts = [b"".join([raw[k] for k in piece.tolist()]).decode() for piece in np.split(own, group[1:]) if len(piece)]
        texts += [raw[k].decode() for k in alone.tolist()]
        found = [f.ids for f in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids = _flat(found)
        reached = np.cumsum(self.length_a[ids])
        # The bytes read so far at the end of each part, in the order of reading.
        order = np.r_[own, alone]
        last = np.searchsorted(reached, np.cumsum(lengths[order]), "left") + 1
        start, times = np.empty((2, len(raw)), np.int64)
        start[order], times[order] = np.r_[0, last][:-1], np.diff(np.r_[0, last])
        b = self.b.encode([r[1:].decode() for r in raw], num_threads=1)
        times_b = np.fromiter(map(len, b), np.int64, len(b))
        sides = [(ids, start, times), (_flat(b), np.cumsum(times_b) - times_b, times_b)]
        good = np.ones(len(raw), bool)
        for (flat, begin, n), own_order, table in zip(sides, (order, np.arange(len(raw))), (self.bytes_a, self.bytes_b), strict=True):
            whole = b"".join(map(table.__getitem__, flat.tolist())) == b"".join([raw[k] for k in own_order.tolist()])
            upto = np.r_[0, np.cumsum((self.length_a if table is self.bytes_a else self.length_b)[flat])]
            if not whole or (upto[begin + n] - upto[begin] != lengths).any():
                good &= [b"".join(table[i] for i in flat[x : x + k].tolist()) == r for r, x, k in zip(raw, begin.tolist(), n.tolist(), strict=True)]
        return sides, good


Side = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids one after the other; first place and number of each part's


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def spans(start: np.ndarray, times: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (times[0] of them), start[1], ... and so on."""
    ends = np.cumsum(times)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + times, times)


def _ends_visible(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is surely visible: ASCII, or of two bytes."""
    return _VISIBLE[data[at - 1]] | _WIDE2[data[at - 2]]


def _begins_visible(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _VISIBLE[data[at]] | _WIDE[data[at]]


def word_parts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the parts of some texts begin, each of which begins with a blank.

    Texts are cut before single blanks between visible characters. The pattern of A begins a word there and never crosses
    the place, and no piece of B goes on with a blank after another character, so the tokens of the parts, one after the
    other, are those of the whole text.
    """
    at = np.flatnonzero(data == 32)
    padded = np.r_[data, 32]
    cut = np.zeros(len(data), bool)
    cut[at[_ends_visible(padded, at) & _begins_visible(padded, at + 1)]] = True
    cut[first] = True
    return np.flatnonzero(cut)


@lru_cache(maxsize=2)
def tokenizers(model_a: str, model_b: str) -> TwoTokenizers:
    return TwoTokenizers(model_a, model_b)


class Aligned:
    """The tokens of both sides for many texts in one row of numbers, their groups, and the pairs that overlap.

    Texts that have no tokens by the rules of ``align_tokens`` have none here.
    """

    def __init__(self, both: TwoTokenizers, texts: list[str | None]):
        self.both, self.n = both, len(texts)
        raw = [b" " + t.encode() if t else b"" for t in texts]
        upto = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        filled = upto[:-1][np.diff(upto) > 0]
        begin = word_parts(data, filled) if both.parts and len(data) else filled
        # Every different part is encoded once.
        offsets = np.r_[begin, len(data)].astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        sides, good = both.encode(coded.dictionary)
        doc = np.searchsorted(upto, begin, "right") - 1
        for bad in np.unique(doc[~good[code]]).tolist():
            own = code[doc == bad]
            read = [x[spans(start[own], times[own])].tolist() for x, start, times in sides]
            if any(b"".join(t[i] for i in x) != raw[bad] for t, x in zip((both.bytes_a, both.bytes_b), read, strict=True)):
                code, doc = code[doc != bad], doc[doc != bad]
        self.n_a, self.n_b = (np.bincount(doc, times[code], minlength=self.n).astype(np.int64) for _, _, times in sides)
        self.a, self.b = (x[spans(start[code], times[code])] for x, start, times in sides)
        self.first_a, self.first_b = (np.r_[0, np.cumsum(n)] for n in (self.n_a, self.n_b))
        # Both sides cover the same bytes without a gap, text after text.
        self.end_a, self.end_b = np.cumsum(both.length_a[self.a]), np.cumsum(both.length_b[self.b])
        self.start_a, self.start_b = self.end_a - both.length_a[self.a], self.end_b - both.length_b[self.b]
        self._group()

    def _group(self) -> None:
        start, end = np.r_[self.start_a, self.start_b], np.r_[self.end_a, self.end_b]
        order = np.lexsort((np.arange(len(start)) >= len(self.a), start))
        reach = np.maximum.accumulate(end[order])
        new = np.r_[True, start[order][1:] >= reach[:-1]][: len(order)]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        self.groups = int(new.sum())
        self.group_a, self.group_b = group[: len(self.a)], group[len(self.a) :]
        # Tokens of each side up to the end of each group.
        self.upto_a = np.cumsum(np.bincount(self.group_a, minlength=self.groups))
        self.upto_b = np.cumsum(np.bincount(self.group_b, minlength=self.groups))

    def first_groups(self) -> np.ndarray:
        """The first group of each text, plus the end."""
        return np.searchsorted(self.upto_a, self.first_a, "right") if self.groups else np.zeros(self.n + 1, np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of the A token, number of the B token) of all pairs whose bytes overlap, by A token."""
        low = np.searchsorted(self.end_b, self.start_a, "right")
        times = np.searchsorted(self.start_b, self.end_a, "left") - low
        return np.repeat(np.arange(len(self.a)), times), spans(low, times)

    def written(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2``; the two sides take turns group by group."""
        size_a, size_b = self.both.size_a, self.both.size_b
        code = np.empty(len(self.a) + len(self.b), np.int64)
        before_b, before_a = np.r_[0, self.upto_b], self.upto_a
        last_a, last_b = np.r_[np.diff(self.group_a) > 0, True], np.r_[np.diff(self.group_b) > 0, True]
        code[np.arange(len(self.a)) + before_b[self.group_a]] = self.a + size_a * last_a[: len(self.a)]
        code[np.arange(len(self.b)) + before_a[self.group_b]] = self.b + 2 * size_a + size_b * last_b[: len(self.b)]
        first, names = self.first_a + self.first_b, self.both.names
        return ["".join(map(names.__getitem__, code[i:j].tolist()))[:-1] for i, j in zip(first[:-1], first[1:], strict=True)]


def _rows(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def align_tokens(
    docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B, text: str = "text"
) -> DataFrame:
    """(doc_id, ids_a, ids_b, ends_a, ends_b) of every row: tokens of both sides and where each group ends.

    A reads a blank and the text, B the text, before which it puts a blank itself; special tokens are not added and
    their strings are plain text. Groups are cut where a token of A and one of B end at the same byte: group k has the
    tokens ends_a[k-1] .. ends_a[k] of A and those of B between the same entries of ends_b. Null and empty texts, and
    texts whose tokens do not give back the blank and the text byte by byte on both sides, have no tokens. Texts are encoded
    part by part (``word_parts``), each different part of a batch once. Repeated rows, ties and null ids come out as they
    are; other columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(model_a, model_b)
        for whole in batches:
            for batch in slices(whole, "text"):
                x = Aligned(both, batch.column(1).to_pylist())
                first = x.first_groups()

                def lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))

                ends = [upto - np.repeat(own[:-1], np.diff(first)) for upto, own in ((x.upto_a, x.first_a), (x.upto_b, x.first_b))]
                columns = [batch.column(0), lists(x.a, x.first_a), lists(x.b, x.first_b), lists(ends[0], first), lists(ends[1], first)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids_a", "ids_b", "ends_a", "ends_b"])

    kinds = ", ".join(f"{c} array<int>" for c in ("ids_a", "ids_b", "ends_a", "ends_b"))
    return _rows(docs, text).mapInArrow(run, f"doc_id bigint, {kinds}")


_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_pairs int"


def _packed(docs: DataFrame, model_a: str, model_b: str, text: str) -> DataFrame:
    """One row per batch of texts: its documents, its id pairs with their links, and the pairs of each document.

    ``at`` and ``times`` hold, document after document, places in ``pairs`` and the document's links with that pair.
    """
    doc_kind = pa.struct([(n, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[t]) for n, t in (c.split() for c in _DOC.split(", "))])
    names = ["batch", "docs", "pairs", "links", "at", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = tokenizers(model_a, model_b), count(TaskContext.get().partitionId() << 32)
        for whole in batches:
            for batch in slices(whole, "text"):
                x = Aligned(both, batch.column(1).to_pylist())
                of_a, of_b = x.links()
                doc = np.searchsorted(x.first_a, of_a, "right") - 1
                pairs, place, links = np.unique(x.a[of_a] * both.size_b + x.b[of_b], return_inverse=True, return_counts=True)
                own, times = np.unique(doc * max(1, len(pairs)) + place, return_counts=True)
                n_pairs = np.bincount(own // max(1, len(pairs)), minlength=x.n).astype(np.int32)
                hashes = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in x.written()]
                columns = [
                    batch.column(0), pa.array(x.n_a), pa.array(x.n_b), pa.array(np.diff(x.first_groups())),
                    pa.array(np.bincount(doc, minlength=x.n)), pa.array(hashes, pa.string()), pa.array(n_pairs),
                ]
                rows = pa.StructArray.from_arrays(columns, fields=list(doc_kind))

                def one(values) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

                out = [pa.array([next(number)]), one(rows), one(pa.array(pairs)), one(pa.array(links))]
                out += [one(pa.array(v.astype(np.int32))) for v in (own % max(1, len(pairs)), times)]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = f"batch bigint, docs array<struct<{_DOC.replace(' ', ':').replace(',:', ',')}>>, pairs array<bigint>, links array<bigint>, at array<int>, times array<int>"
    return _rows(docs, text).mapInArrow(run, schema)


def pair_counts(packed: DataFrame, size_b: int) -> DataFrame:
    """(pair, total, best): links of every id pair in the whole corpus, and whether its B id has no pair with more."""
    each = packed.select(F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("p.pairs", "p.links")
    totals = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("links").alias("total")), "pair-counts")
    id_b = F.col("pair") % size_b
    top = totals.groupBy(id_b.alias("id_b")).agg(F.max("total").alias("most"))
    named = totals.withColumn("id_b", id_b).join(top, "id_b")
    return named.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignment_digests(
    docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B, text: str = "text"
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; see ``align_tokens``.

    Links are all pairs of an A and a B token whose bytes overlap; the count of an id pair is its links in all rows
    together. ``n_best`` counts the links whose pair no other pair of the same B id outnumbers, ``count_sum`` adds the
    counts over the links. ``groups_sha256`` digests the groups written as ``a1,a2|b1;a3|b2``; '' without tokens.

    Texts are encoded once. What travels is one row per id pair and batch of texts (about 2 MB, a longer text alone),
    so a pair that every text holds is no hot key, and the counts come back to the batch they are for.
    """
    both = tokenizers(model_a, model_b)
    packed = stored(_packed(docs, model_a, model_b, text), "alignments")
    scored = pair_counts(packed, both.size_b)
    each = packed.select("batch", F.posexplode("pairs").alias("place", "pair"))
    back = each.join(scored, "pair").groupBy("batch").agg(F.collect_list(F.struct("place", "total", "best")).alias("scores"))
    ready = packed.select("batch", "docs", "at", "times").join(back, "batch", "left").select("docs", "at", "times", "scores")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                rows, at, times, scores = (batch.column(i)[row].values for i in range(4))
                at, times = np.asarray(at), np.asarray(times).astype(np.int64)
                totals, best = np.zeros((2, len(scores) if scores is not None else 0), np.int64)
                if len(totals):
                    place = np.asarray(scores.field(0))
                    totals[place], best[place] = np.asarray(scores.field(1)), np.asarray(scores.field(2).cast(pa.int64()))
                upto = np.cumsum(np.r_[0, np.asarray(rows.field(6))])
                sums = [np.r_[0, np.cumsum(v[at] * times)] for v in (best, totals)]
                more = [pa.array(s[upto[1:]] - s[upto[:-1]]) for s in sums]
                columns = [*(rows.field(i) for i in range(5)), *more, rows.field(5)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kinds = ", ".join(f"{c} bigint" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return ready.mapInArrow(total, f"{kinds}, groups_sha256 string")
