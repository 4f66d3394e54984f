"""Documents to overlapping token windows with character spans."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import MODEL_INPUT, OVERLAP, token_count

TokenSpans = Callable[[str], Sequence[tuple[str, int, int]]]

_TOKENS = "array<struct<pos:int,token:string,start:int,end:int>>"
# Possessive forms, so that Java walks a counted run of tokens in a loop and never backtracks into a token.
_ONE = r"\s*+(?:\w++|[^\w\s])"
_BLANKS = " \t\n\x0b\f\r"  # what the patterns take for white space
_BLOCK = 4  # numbers that are summed in one expression


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(numbers: Column) -> Column:
    """0 and the sums of the first, the first two, … numbers."""
    whole = lambda own: F.slice(F.concat(F.array(F.lit(0)), _sums(own)), F.lit(1), F.size(own) + 1)
    return F.when(numbers.isNotNull(), _let(numbers, whole))


def _sums(numbers: Column, levels: int = 8) -> Column:
    """The sums of the first, the first two, … numbers, and up to a block of nulls.

    Sums inside blocks are written out; the totals of the blocks are summed the same way, and few are left for a fold,
    which copies what it has so far at every step.
    """
    if levels == 0:
        first = F.slice(numbers, 1, 1)
        return F.reduce(F.slice(numbers, F.lit(2), F.size(numbers)), first, lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))

    def inside(block: Column) -> Column:
        each = [F.get(block, F.lit(j)) for j in range(_BLOCK)]
        return F.array(*[reduce(Column.__add__, each[: j + 1]) for j in range(_BLOCK)])

    def blocked(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), F.lit(_BLOCK))
        return F.transform(F.transform(starts, lambda at: F.slice(own, at, F.lit(_BLOCK))), inside)

    def joined(blocks: Column) -> Column:
        # What is missing in the last block makes its total null, which no block comes after.
        upto = _sums(F.transform(blocks, lambda b: F.get(b, F.lit(_BLOCK - 1))), levels - 1)
        before = lambda b, s: F.array(*[s + F.get(b, F.lit(j)) for j in range(_BLOCK)])
        later = _let(upto, lambda s: F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), lambda b, k: before(b, F.get(s, k))))
        return F.concat(F.get(blocks, F.lit(0)), F.flatten(later))

    many = _let(_let(numbers, blocked), joined)
    return F.when(F.size(numbers) > _BLOCK, many).otherwise(inside(numbers)) if levels < 8 else many


def _native_tokens(text: Column, add_special: bool) -> Column:
    """Array of (pos, token, start, end) of the default tokenizer: one pass of the pattern, blanks before a token with it."""

    def marker(pos: Column, token: str) -> Column:
        return F.array(F.struct(pos.alias("pos"), F.lit(token).alias("token"), F.lit(0).alias("start"), F.lit(0).alias("end")))

    def spans(pieces: Column) -> Column:
        tokens = F.transform(pieces, lambda p: F.ltrim(p, F.lit(_BLANKS)))
        first = 1 if add_special else 0

        def numbered(ends: Column) -> Column:
            return F.transform(tokens, lambda t, i: F.struct(
                (i + first).alias("pos"), t.alias("token"), (F.get(ends, i) - F.length(t)).alias("start"), F.get(ends, i).alias("end")
            ))

        found = _let(_sums(F.transform(pieces, F.length)), numbered)
        return F.concat(marker(F.lit(0), "[CLS]"), found, marker(F.size(pieces) + 1, "[SEP]")) if add_special else found

    return _let(F.regexp_extract_all(text, F.lit(_ONE), F.lit(0)), spans)


def tokenize(df: DataFrame, text: str, tokenizer: TokenSpans | None = None, add_special: bool = True) -> DataFrame:
    """Adds ``tokens``: position, token, and character span; the markers have the span (0, 0).

    The default cuts word runs and punctuation marks, natively. ``tokenizer`` maps a text to (token, start, end) triples
    and runs in Python on Arrow batches. Jobs that need only counts or chunk spans use those forms instead.
    """
    if tokenizer is None:
        # A generator keeps later filters and fields on one copy of the array.
        return df.select(*[c for c in df.columns if c != "tokens"], F.explode(F.array(_native_tokens(F.col(text), add_special))).alias("tokens"))

    @F.pandas_udf(_TOKENS)
    def spans(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if t is None:
                out.append(None)
                continue
            found = list(tokenizer(t))
            if add_special:
                found = [("[CLS]", 0, 0), *found, ("[SEP]", 0, 0)]
            out.append([{"pos": i, "token": k, "start": s, "end": e} for i, (k, s, e) in enumerate(found)])
        return pd.Series(out)

    # Not repeatable for the optimizer, which else puts a copy of the call below filters on its result.
    return df.withColumn("tokens", spans.asNondeterministic()(F.col(text)))


def check_length(
    df: DataFrame, text: str, max_tokens: int = MODEL_INPUT, add_special: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(ok, rejected): texts with more tokens than the model takes are errors when not truncated."""
    # A generator is no target for filter pushdown, so the tokens are counted once and not once per use.
    counted = df.select("*", F.explode(F.array(token_count(F.col(text), add_special))).alias("n_tokens"))
    over = F.col("n_tokens") > max_tokens
    reason = F.format_string("%d tokens, the model takes %d", F.col("n_tokens"), F.lit(max_tokens))
    return counted.filter(~over), counted.filter(over).withColumn("reason", reason)


def _window_bounds(n: Column, size: int, overlap: int) -> Column:
    """Array of (chunk_no, tok_start, tok_end, input_end) for ``n`` tokens including markers."""
    step = size - overlap
    numbers = F.sequence(F.lit(0), F.ceil(n / F.lit(step)).cast("int") - 1)

    def bounds(k: Column) -> Column:
        end = F.least(F.lit(step) * (k + 1), n)
        ahead = F.when(end + overlap < n, end + overlap).otherwise(end)
        return F.struct(
            k.alias("chunk_no"),
            (F.lit(step) * k).alias("tok_start"),
            end.alias("tok_end"),
            ahead.alias("input_end"),
        )

    return F.transform(numbers, bounds)


def chunk_windows(
    df: DataFrame, size: int = MODEL_INPUT, overlap: int = OVERLAP, tokens: str = "tokens"
) -> DataFrame:
    """One row per chunk of a token array: bounds, the model input, and the character span.

    A chunk covers ``size - overlap`` tokens; its input looks ``overlap`` tokens ahead only if more than that remain.
    The span ends at the token two before the end of the chunk. Fewer than two tokens are no document.
    """
    kept = [c for c in df.columns if c != tokens]
    t = F.col(tokens)
    n = F.size(t)

    def window(b: Column) -> Column:
        start, end = b["tok_start"], b["tok_end"]
        return F.struct(
            *[b[c].alias(c) for c in ("chunk_no", "tok_start", "tok_end", "input_end")],
            F.slice(t, start + 1, b["input_end"] - start).getField("token").alias("input_tokens"),
            F.element_at(t, start + 1).getField("start").cast("bigint").alias("chunk_start"),
            F.element_at(t, end - 1).getField("end").cast("bigint").alias("chunk_end"),
        )

    # Each window takes its own tokens before the rows are made, so no row carries the whole text.
    return df.filter(n >= 2).select(*kept, F.inline(F.transform(_window_bounds(n, size, overlap), window)))


def chunk_spans(
    df: DataFrame, text: str, size: int = MODEL_INPUT, overlap: int = OVERLAP, with_input: bool = False
) -> DataFrame:
    """One row per chunk for the default tokenizer, without Python and without exploding tokens.

    A blank-separated stand-in for the start marker is put before the text, which is then cut into runs of
    ``size - overlap`` tokens by one counted pattern. Summed run lengths give the character spans; the result equals
    ``chunk_windows(tokenize(..))``. ``with_input`` adds the text the model sees.
    """
    step = size - overlap
    kept = [c for c in df.columns if c != text]
    marked = F.concat(F.lit("x "), F.col(text))
    runs = df.select(
        *kept,
        (F.col(text) == "").alias("_empty"),
        F.regexp_extract_all(marked, F.lit(f"(?:{_ONE}){{1,{step}}}+"), F.lit(0)).alias("_runs"),
    )
    # A full last run leaves no place for the end marker, which becomes a chunk of its own.
    full = token_count(F.element_at("_runs", -1), add_special=False) == step
    sums = F.explode(F.array(running_sums(F.transform("_runs", F.length))))  # a generator: computed once
    lens = runs.select("*", full.alias("_marker_only"), sums.alias("_upto"))
    total = lambda upto: F.get("_upto", upto)
    last = F.size("_runs")

    def piece(r: Column, i: Column) -> Column:
        before = total(i)
        begins = F.length(r) - F.length(F.regexp_replace(r, r"^\s+", ""))
        # The last run ends with the text, unless the end marker falls into a chunk of its own; others end one token
        # early. Read backwards, that token is found at once.
        last_token = F.length(F.regexp_extract(F.reverse(r), r"^(?:\w++|[^\w\s])\s*+", 0))
        whole = (i + 1 == last) & ~F.col("_marker_only")
        stop = before + F.length(r) - F.when(whole, F.lit(0)).otherwise(last_token)
        return F.struct(
            i.alias("chunk_no"),
            F.when(i == 0, 0).otherwise(before + begins - 2).cast("bigint").alias("chunk_start"),
            F.greatest(stop - 2, F.lit(0)).cast("bigint").alias("chunk_end"),
            *([_run_input(r, i, overlap).alias("input")] if with_input else []),
        )

    tail = F.struct(
        last.alias("chunk_no"),
        F.lit(0).cast("bigint").alias("chunk_start"),
        (total(last) - 2).cast("bigint").alias("chunk_end"),
        *([F.lit("").alias("input")] if with_input else []),
    )
    pieces = F.transform("_runs", piece)
    extra = F.when(F.col("_marker_only"), F.array(tail)).otherwise(F.slice(F.array(tail), 1, 0))
    return lens.select(*kept, F.inline(F.when(~F.col("_empty"), F.concat(pieces, extra))))


def _run_input(run: Column, i: Column, overlap: int) -> Column:
    """Text of a run without the stand-in, plus the first tokens of the next run if that many follow."""
    own = F.when(i == 0, F.substring(run, 3, 2**31 - 1)).otherwise(run)
    ahead = F.regexp_extract(F.get("_runs", i + 1), f"^(?:{_ONE}){{{overlap}}}+", 0)
    return F.concat(own, F.coalesce(ahead, F.lit("")))
