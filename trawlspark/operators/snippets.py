"""Chunk text of a hit and its keyword snippet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_snippet_text, is_keyword, query_text, words

# Words a snippet must span, words and URL form of a result card.
MIN_WINDOW = 100
CARD_WORDS = 150


def hit_defaults(hits: DataFrame) -> DataFrame:
    """Missing title, content, start and end of a hit; the end falls back to a quarter of the content's bytes."""
    content = F.coalesce(F.col("content"), F.lit(""))
    return hits.withColumns(
        {
            "title": F.coalesce(F.col("title"), F.lit("")),
            "content": content,
            "chunk_start": F.coalesce(F.col("chunk_start"), F.lit(0).cast("bigint")),
            "chunk_end": F.coalesce(F.col("chunk_end"), F.floor(F.octet_length(content) / 4).cast("bigint")),
        }
    )


def chunk_text(content: Column, start: Column, end: Column) -> Column:
    """Characters [start, end) of the content.

    A start behind the end replaces the end by byte length minus start. What then does not fit gives "".
    """
    stop = F.when(start > end, F.octet_length(content) - start).otherwise(end)
    size = F.length(content)
    outside = (start > stop) | (stop > size) | (start > size)
    text = F.substring(content, (start + 1).cast("int"), (stop - start).cast("int"))
    return F.when(outside, F.lit("")).otherwise(text)


def keyword_positions(word_array: Column, query: Column) -> Column:
    """0-based positions of the keywords, ascending."""
    marked = F.transform(word_array, lambda w, i: F.when(is_keyword(w, query), i))
    return F.filter(marked, lambda i: i.isNotNull())


def keyword_gaps(positions: Column) -> Column:
    """(gap, pos) per keyword: distance to the keyword before, 0 for the first and after a keyword at position 0."""

    def gap(pos: Column, i: Column) -> Column:
        before = F.get(positions, i - 1)
        return F.struct(
            F.when((i == 0) | (before == 0), F.lit(0)).otherwise(pos - before).alias("gap"), pos.alias("pos")
        )

    return F.transform(positions, gap)


def snippet_ranges(df: DataFrame, text: str, query: str, min_window: int = MIN_WINDOW) -> DataFrame:
    """Adds _words, snippet_start and snippet_end (null where a text gives no snippet).

    The snippet begins at the first keyword and ends at the keyword with the largest (gap, position) of those more
    than ``min_window`` words behind it: the last such keyword once keywords are stably sorted by gap.
    """
    found = (
        df.withColumn("_words", words(clean_snippet_text(text)))
        .withColumn("_keys", keyword_positions(F.col("_words"), F.lower(F.col(query))))
        .withColumn("snippet_start", F.get("_keys", F.lit(0)))
        .withColumn("_gaps", keyword_gaps(F.col("_keys")))
    )
    far = F.filter("_gaps", lambda g: g["pos"] > F.col("snippet_start") + min_window)
    end = F.when(F.size("_words") > min_window, F.array_max(far).getField("pos"))
    return (
        found.withColumn("snippet_end", end)
        .withColumn("snippet_start", F.when(F.col("snippet_end").isNotNull(), F.col("snippet_start")))
        .drop("_keys", "_gaps")
    )


def snippet(df: DataFrame, text: str, query: str, out: str = "summary", min_window: int = MIN_WINDOW) -> DataFrame:
    """Adds the snippet, or the unchanged text where there is none."""
    start, end = F.col("snippet_start"), F.col("snippet_end")
    cut = F.array_join(F.slice("_words", start + 1, end - start), " ")
    ranged = snippet_ranges(df, text, query, min_window)
    return ranged.withColumn(out, F.when(end.isNotNull(), cut).otherwise(F.col(text))).drop(
        "_words", "snippet_start", "snippet_end"
    )


def summarize_hits(hits: DataFrame, query: str = "query") -> DataFrame:
    """Hits (url, title, content, chunk_start, chunk_end, query) with their ``summary``; hits without URL drop out."""
    full = hit_defaults(hits.filter(F.col("url").isNotNull()))
    sliced = full.withColumn("_text", chunk_text(F.col("content"), F.col("chunk_start"), F.col("chunk_end")))
    asked = sliced.withColumn("_asked", query_text(F.col(query), F.col("title")))
    return snippet(asked, "_text", "_asked").drop("_text", "_asked")


def result_cards(results: DataFrame) -> DataFrame:
    """Display form: no slash at the end of the URL, a bounded summary, the URL for an empty title."""
    url = F.regexp_replace("url", "/$", "")
    return results.withColumns(
        {
            "title": F.when(F.col("title") == "", url).otherwise(F.col("title")),
            "summary": F.array_join(F.slice(F.split("summary", " "), 1, CARD_WORDS), " "),
            "url": url,
        }
    )
