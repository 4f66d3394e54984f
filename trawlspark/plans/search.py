"""Search: queries in, ranked results with snippets out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.embed import EmbedConfig, embed_texts
from ..operators.search import attach_documents, top_documents
from ..operators.snippets import summarize_hits
from ..session import stored


def search_vectors(
    chunks: DataFrame,
    documents: DataFrame,
    query_vectors: DataFrame,
    limit: int = 10,
    offset: int = 0,
    assume_fk: bool = False,
    lookup: bool = False,
) -> DataFrame:
    """Results (query_id, rank, url, score, summary, title) of embedded queries (query_id, query, vector).

    Per-query columns limit and offset, if present, replace the two arguments. ``lookup`` fetches the ids of the result
    pages and pushes them into the document scan (``attach_documents``); without it any number of results will do.
    The queries are written once to the shared folder, so each is embedded once; the tasks read them there.
    """
    query_vectors = stored(query_vectors, "asked")
    page = top_documents(chunks, documents, query_vectors, limit, offset, assume_fk, written=True)
    hits = attach_documents(page, documents, lookup)
    asked = hits.join(query_vectors.select("query_id", "query"), "query_id")
    return summarize_hits(asked).select(
        "query_id", "rank", "url", F.col("similarity").alias("score"), "summary", "title"
    )


def search(
    chunks: DataFrame,
    documents: DataFrame,
    queries: DataFrame,
    limit: int = 10,
    offset: int = 0,
    cfg: EmbedConfig = EmbedConfig(),
    assume_fk: bool = False,
    lookup: bool = False,
) -> DataFrame:
    """``search_vectors`` for plain texts (query_id, query): embeds them first; empty queries give no results."""
    embedded, _ = embed_texts(queries, "query", cfg, "vector")
    return search_vectors(chunks, documents, embedded, limit, offset, assume_fk, lookup)
