"""Document and chunk table states: upsert, lookup, missing rows, referential checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_documents(
    old: DataFrame, new: DataFrame, as_of: Column, conflict_content: str = "new", order: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(table, ids) after writing ``new`` (doc_id, url, title, content) over ``old``, unique on url.

    A known URL keeps its doc_id, title and created_at and gets content and updated_at; ``ids`` gives the surviving
    doc_id per URL. ``conflict_content="url"`` stores the URL as content on a conflict. Several new rows of one URL
    count in ``order`` (default doc_id): the first inserts, the last updates.
    """
    if conflict_content not in ("new", "url"):
        raise ValueError("conflict_content must be 'new' or 'url'")
    step = F.col(order or "doc_id")
    offered = new.groupBy("url").agg(
        F.min_by(F.struct("doc_id", "title", "content"), step).alias("_first"),
        F.max_by("content", step).alias("_last"),
        F.count(F.lit(1)).alias("_writes"),
    )
    stamps = [c for c in ("created_at", "updated_at") if c in old.columns]
    before = old.select("url", F.struct("doc_id", "title", "content", *stamps).alias("_old"))
    joined = before.join(offered, "url", "full_outer")
    known, touched = F.col("_old").isNotNull(), F.col("_first").isNotNull()
    conflict = (known & touched) | (F.col("_writes") > 1)
    update = F.col("url") if conflict_content == "url" else F.col("_last")
    content = (
        F.when(conflict, update).when(touched, F.col("_first.content")).otherwise(F.col("_old.content"))
    )
    created = F.coalesce(F.col("_old.created_at"), as_of) if "created_at" in stamps else as_of
    kept_stamp = F.col("_old.updated_at") if "updated_at" in stamps else as_of
    table = joined.select(
        F.when(known, F.col("_old.doc_id")).otherwise(F.col("_first.doc_id")).alias("doc_id"),
        "url",
        content.alias("content"),
        F.when(known, F.col("_old.title")).otherwise(F.col("_first.title")).alias("title"),
        created.alias("created_at"),
        F.when(touched, as_of).otherwise(kept_stamp).alias("updated_at"),
    )
    ids = joined.filter(touched).select(
        "url", F.when(known, F.col("_old.doc_id")).otherwise(F.col("_first.doc_id")).alias("doc_id")
    )
    return table, ids


def lookup_documents(ids: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing): ids (doc_id) with their content; no row and null content are both errors."""
    marked = documents.select("doc_id", "content", F.lit(True).alias("_row"))
    joined = ids.join(marked, "doc_id", "left")
    has_text = F.col("content").isNotNull()
    reason = F.when(F.col("_row").isNull(), "no document found").otherwise("document without content")
    return (
        joined.filter(has_text).drop("_row"),
        joined.filter(~has_text).select(*ids.columns, reason.alias("reason")),
    )


def missing_documents(documents: DataFrame, chunks: DataFrame, null_safe: bool = False) -> DataFrame:
    """Ids of documents without a chunk, as ``NOT IN``: one chunk without doc_id yields no rows at all.

    ``null_safe`` skips the null rule. A hash anti-join plus one existence test; never a broadcast of the chunk table.
    """
    done = chunks.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    left = documents.select("doc_id").distinct().join(done, "doc_id", "left_anti")
    if null_safe:
        return left
    return left.filter(~chunks.filter(F.col("doc_id").isNull()).exists())


def orphan_chunks(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks that name a document which does not exist."""
    return chunks.filter(F.col("doc_id").isNotNull()).join(documents.select("doc_id"), "doc_id", "left_anti")


def delete_documents(documents: DataFrame, chunks: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, chunks) without the given ids; chunks go with their document."""
    gone = ids.select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti"), chunks.join(gone, "doc_id", "left_anti")


def touch(df: DataFrame, as_of: Column) -> DataFrame:
    """Rows about to be rewritten get a new updated_at."""
    return df.withColumn("updated_at", as_of)
