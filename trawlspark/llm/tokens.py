"""Token counts of texts of any length (operator 5)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MODEL = "piece_bpe_32k.model"


class Encoder:
    """One tokenizer of the public files: counts, offsets, and places where a cut is proven harmless."""

    def __init__(self, name: str):
        import public_tokenizers

        path = public_tokenizers.path(name)
        self.pieces = name.endswith(".model")
        if self.pieces:
            from sentencepiece import SentencePieceProcessor

            self.model = SentencePieceProcessor(model_file=path)
            vocabulary = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
            # No piece goes on with a blank after another character, so no merge ever crosses the start of a blank.
            self.safe = re.compile("(?<=[^ ▁])[ ▁]") if not any("▁" in p.lstrip("▁") for p in vocabulary) else None
        else:
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.no_padding()
            self.model.no_truncation()
            # The word patterns of these files never run from a visible character into a single blank.
            self.safe = re.compile(r"(?<=[^\s]) (?=[^\s])")

    def counts(self, texts: list[str]) -> list[int]:
        if self.pieces:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]

    def starts(self, text: str) -> list[int]:
        """Start of each token, as a character offset; ascending."""
        if self.pieces:
            begins = np.array([p.begin for p in self.model.encode(text, return_type="proto").pieces], np.int64)
            data = np.frombuffer(text.encode(), np.uint8)  # the library counts bytes
            return np.cumsum(np.r_[0, (data & 0xC0) != 0x80])[begins].tolist()
        return [a for a, _ in self.model.encode(text, add_special_tokens=False).offsets]


@lru_cache(maxsize=4)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def spliced_count(enc: Encoder, text: str, chunk: int, overlap: int) -> int:
    """Tokens of the whole ``text``, encoded in chunks that overlap.

    Two neighbouring chunks are joined at a place in their overlap where both begin a token and where no token of the
    model can cross (``safe``), so what lies before is as in the whole text for the left chunk, and what lies after
    for the right one. Without such a place the overlap is doubled; once it is the whole left chunk, that chunk is
    made longer, up to the end of the text.
    """

    def starts(begin: int, end: int) -> list[int]:
        return [begin + s for s in enc.starts(text[begin:end])]

    n, total, begin, done = len(text), 0, 0, 0  # the chunk is [begin, end); tokens before ``done`` are counted
    end = min(chunk, n)
    left = starts(begin, end)
    while end < n:
        cut, width = None, overlap
        while cut is None and enc.safe and width < end - begin:
            start = end - width
            stop = min(n, start + max(chunk, 2 * width))
            right = starts(start, stop)
            cut = _common_cut(enc, text, left, right, max(start, done) + 1, end)
            width *= 2
        if cut is None:
            end = min(n, begin + 2 * (end - begin))
            left = starts(begin, end)
        else:
            total += sum(done <= s < cut for s in left)
            left, begin, done, end = right, start, cut, stop
    return total + sum(s >= done for s in left)


def _common_cut(enc: Encoder, text: str, left: list[int], right: list[int], low: int, high: int) -> int | None:
    """The last proven cut in [low, high) at which both chunks begin a token."""
    both = set(left) & set(right)
    # The look-behind and look-ahead read the neighbours of the place in the whole text.
    cuts = [m.start() for m in enc.safe.finditer(text, low, high)]
    return next((c for c in reversed(cuts) if c in both), None)


def count_tokens(
    docs: DataFrame, model: str = MODEL, limit: int = 4096, chunk: int = 65_536, overlap: int = 1024, text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text, without added special tokens.

    Texts above ``chunk`` characters are encoded in overlapping chunks and spliced (``spliced_count``), so a worker
    holds the tokens of one chunk only. Null and empty texts have no bytes and no tokens. Repeated rows, ties and null
    ids come out as they are; other columns are not read. An empty table gives an empty result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                found: list[int] = []
                for long, run in groupby(texts, lambda t: len(t) > chunk):
                    found += [spliced_count(enc, t, chunk, overlap) for t in run] if long else enc.counts(list(run))
                size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), size, pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
