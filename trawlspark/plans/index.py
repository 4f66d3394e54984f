"""Documents to rows of the chunk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.documents import lookup_documents, missing_documents
from ..operators.embed import EmbedConfig, chunk_table, embed_chunks


def index_documents(documents: DataFrame, as_of: Column, cfg: EmbedConfig = EmbedConfig()) -> DataFrame:
    """Chunk rows of documents (doc_id, content). Every document is cut where it lies: no shuffle."""
    usable = documents.select("doc_id", "content").filter(F.coalesce(F.col("content"), F.lit("")) != "")
    return chunk_table(embed_chunks(usable, "content", cfg), as_of)


def index_ids(
    ids: DataFrame, documents: DataFrame, as_of: Column, cfg: EmbedConfig = EmbedConfig()
) -> tuple[DataFrame, DataFrame]:
    """(chunks, missing) for document ids (doc_id)."""
    found, missing = lookup_documents(ids, documents)
    return index_documents(found, as_of, cfg), missing


def replay_missing(documents: DataFrame, chunks: DataFrame, null_safe: bool = False) -> DataFrame:
    """Ids to send to the embedder again."""
    return missing_documents(documents, chunks, null_safe)


def replace_chunks(chunks: DataFrame, fresh: DataFrame) -> DataFrame:
    """Chunk table in which re-indexed documents keep only their fresh chunks."""
    return chunks.join(fresh.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(fresh)
