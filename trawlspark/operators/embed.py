"""Texts to vectors with a pluggable model, and the write checks of the chunk table."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import new_id
from ..functions.tokens import MODEL_INPUT, OVERLAP, TOKEN_PATTERN, token_array, truncate_tokens
from .arrays import collect_arrays
from .chunks import TokenSpans, check_length, chunk_spans, chunk_windows, tokenize

# A model is made once per Python worker and maps texts to one row of numbers each.
Encoder = Callable[[Sequence[str]], np.ndarray]


@dataclass(frozen=True)
class EmbedConfig:
    """Options of a model. ``make_model`` builds the encoder on the worker; None takes the hashing model."""

    make_model: Callable[["EmbedConfig"], Encoder] | None = None
    dims: int = 64
    mean_pooling: bool = True
    normalize: bool = False
    max_tokens: int = MODEL_INPUT
    overlap: int = OVERLAP
    add_special: bool = True
    truncate: bool = True
    batch_rows: int = 256
    tokenizer: TokenSpans | None = None
    options: dict = field(default_factory=dict)


def hashing_model(cfg: EmbedConfig) -> Encoder:
    """Each token is a one-hot vector at md5(lower-cased token) mod ``dims``; mean or first-token pooling."""
    find = re.compile(TOKEN_PATTERN, re.ASCII).findall
    slot: dict[str, int] = {}

    def bucket(token: str) -> int:
        at = slot.get(token)
        if at is None:
            if len(slot) > 500_000:
                slot.clear()
            at = slot[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % cfg.dims
        return at

    def encode(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), cfg.dims))
        for i, text in enumerate(texts):
            tokens = find(text.lower()) or ["[sep]"]
            if cfg.mean_pooling:
                hits = np.fromiter(map(bucket, tokens), np.int64, len(tokens))
                out[i] = np.bincount(hits, minlength=cfg.dims) / len(tokens)
            else:
                out[i, bucket(tokens[0])] = 1.0
        return out

    return encode


def embed_column(df: DataFrame, text: str, cfg: EmbedConfig = EmbedConfig(), out: str = "embedding") -> DataFrame:
    """Adds one vector per row; rows go through the model in small batches and keep all other columns."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches):
        model = (cfg.make_model or hashing_model)(cfg)
        for batch in batches:
            if out in batch.schema.names:
                batch = batch.drop_columns([out])
            for at in range(0, batch.num_rows, cfg.batch_rows):
                part = batch.slice(at, cfg.batch_rows)
                vectors = np.asarray(model(part.column(text).to_pylist()), dtype=np.float64)
                if cfg.normalize:
                    with np.errstate(invalid="ignore", divide="ignore"):
                        vectors = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
                starts = np.arange(0, vectors.size + 1, vectors.shape[1], dtype=np.int32)
                values = pa.ListArray.from_arrays(starts, pa.array(vectors.astype(np.float32).ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, out])

    return df.mapInArrow(run, schema)


def embed_texts(
    df: DataFrame, text: str = "text", cfg: EmbedConfig = EmbedConfig(), out: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """(embedded, rejected) for short texts such as queries. Empty texts are errors.

    With ``cfg.truncate`` a long text is cut to the model input, else it is an error.
    """
    empty = F.coalesce(F.col(text) == "", F.lit(True))
    rejected = df.filter(empty).withColumn("reason", F.lit("empty text"))
    usable = df.filter(~empty)
    if cfg.truncate:
        fit = F.array_join(truncate_tokens(token_array(F.col(text)), cfg.max_tokens, cfg.add_special), " ")
        vectors = embed_column(usable.withColumn("_fit", fit), "_fit", cfg, out).drop("_fit")
    else:
        usable, long = check_length(usable, text, cfg.max_tokens, cfg.add_special)
        rejected = rejected.unionByName(long.drop("n_tokens"))
        vectors = embed_column(usable.drop("n_tokens"), text, cfg, out)
    return vectors, rejected


def embed_chunks(df: DataFrame, text: str, cfg: EmbedConfig = EmbedConfig()) -> DataFrame:
    """Documents cut into overlapping windows, one vector per window: adds chunk_no, chunk_start, chunk_end, embedding."""
    if cfg.tokenizer is None and cfg.add_special:
        pieces = chunk_spans(df, text, cfg.max_tokens, cfg.overlap, with_input=True)
    else:
        tokens = tokenize(df, text, cfg.tokenizer, cfg.add_special).drop(text)
        windows = chunk_windows(tokens, cfg.max_tokens, cfg.overlap)
        real = F.filter("input_tokens", lambda t: ~t.isin("[CLS]", "[SEP]"))
        pieces = windows.withColumn("input", F.array_join(real, " ")).drop(
            "tok_start", "tok_end", "input_end", "input_tokens"
        )
    return embed_column(pieces, "input", cfg).drop("input")


def bad_vector(v: Column, dims: int) -> Column:
    """Whether a vector is missing, has another length, or has no direction."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x)) | F.forall(v, lambda x: x == 0)
    return F.coalesce((F.size(v) != dims) | odd, F.lit(True))


def check_chunks(chunks: DataFrame, dims: int) -> DataFrame:
    """Fails the write on a bad vector."""
    v = F.col("embedding")
    bad = bad_vector(v, dims)
    error = F.raise_error(F.concat(F.lit("bad vector for chunk "), F.col("chunk_id").cast("string")))
    return chunks.withColumn("embedding", F.when(bad, error.cast("array<float>")).otherwise(v))


def chunk_table(embedded: DataFrame, as_of: Column) -> DataFrame:
    """Rows of the chunk table with replay-stable ids."""
    return embedded.select(
        new_id(as_of, F.col("doc_id"), F.col("chunk_no")).alias("chunk_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
        "chunk_start",
        "chunk_end",
        "embedding",
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    )


def chunk_arrays(chunks: DataFrame) -> DataFrame:
    """Per document the parallel arrays of a bulk insert."""
    return collect_arrays(chunks, "doc_id", "chunk_id", "chunk_id", "chunk_start", "chunk_end", "embedding")
