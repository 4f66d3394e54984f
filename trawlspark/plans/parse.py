"""Page messages to documents, links and document ids."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import new_id
from ..operators.documents import upsert_documents
from ..operators.frontier import enqueue_links, in_scope
from ..operators.pages import extract_pages, link_rows, page_content, split_empty, split_invalid


class ParsedPages(NamedTuple):
    documents: DataFrame  # new state of the document table
    doc_ids: DataFrame  # (url, doc_id) to embed
    links: DataFrame  # frontier rows to append
    rejects: DataFrame  # (id, url, reason)


def read_pages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages, rejects): messages (id, content, depth, url) with title, content and links."""
    valid, invalid = split_invalid(messages.withColumnRenamed("content", "html"), "id", "html")
    ok, empty = split_empty(extract_pages(valid))
    rejects = invalid.select("id", "url", "reason").unionByName(empty.select("id", "url", "reason"))
    return page_content(ok).drop("body", "hrefs"), rejects


def document_rows(pages: DataFrame, as_of: Column) -> DataFrame:
    return pages.select(new_id(as_of, F.col("url")).alias("doc_id"), "url", "title", "content", F.col("id").alias("msg_id"))


def parse_pages(
    messages: DataFrame, documents: DataFrame, frontier: DataFrame, sites: DataFrame, as_of: Column
) -> ParsedPages:
    """Documents are upserted by URL, links of configured hosts are queued if new, one level deeper."""
    pages, rejects = read_pages(messages)
    table, doc_ids = upsert_documents(documents, document_rows(pages, as_of), as_of, order="msg_id")
    links = in_scope(link_rows(pages, "id"), sites).select("url", "host", "depth")
    return ParsedPages(table, doc_ids, enqueue_links(frontier, links, as_of), rejects)
