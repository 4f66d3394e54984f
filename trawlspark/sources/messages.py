"""Raw page messages as JSON, and search requests and results as JSON."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import new_id
from ..schemas import MESSAGE, SEARCH_REQUEST


def to_messages(pages: DataFrame, as_of: Column, content: str = "content") -> DataFrame:
    """(id, message): body, depth and url of a page wrapped as JSON under a new id."""
    named = pages.withColumn("_id", new_id(as_of, F.col("url")))
    body = F.struct(F.col("_id").alias("id"), F.col(content).alias("content"), F.col("depth").cast("int").alias("depth"), "url")
    return named.select(F.col("_id").alias("id"), F.to_json(body, {"ignoreNullFields": "false"}).alias("message"))


def _decoded(df: DataFrame, text: str, schema) -> DataFrame:
    """``df`` plus one ``_``-prefixed column per JSON field.

    The generator keeps filters on the fields above it; as a plain projection the parse would be repeated for every
    field a pushed-down filter names.
    """
    record = F.inline(F.array(F.from_json(F.col(text), schema, {"mode": "PERMISSIVE"})))
    return df.select("*", record.alias(*[f"_{name}" for name in schema.names]))


def read_messages(df: DataFrame, message: str = "message") -> tuple[DataFrame, DataFrame]:
    """(messages, rejected): decoded records, and the rows that are no JSON record of all four fields."""
    parsed = _decoded(df, message, MESSAGE)
    others = [c for c in df.columns if c != message and c not in MESSAGE.names]
    good = reduce(and_, [F.col(f"_{name}").isNotNull() for name in MESSAGE.names])
    return (
        parsed.filter(good).select(*others, *[F.col(f"_{name}").alias(name) for name in MESSAGE.names]),
        parsed.filter(~good).select(*df.columns, F.lit("bad message").alias("reason")),
    )


def write_messages(pages: DataFrame, as_of: Column, path: str) -> None:
    to_messages(pages, as_of).write.mode("append").parquet(path)


def read_requests(df: DataFrame, request: str = "request") -> tuple[DataFrame, DataFrame]:
    """(requests, rejected): JSON search requests; the query must not be empty, the numbers fit 31 bits."""
    parsed = _decoded(df, request, SEARCH_REQUEST)
    top = F.lit(2**31 - 1)
    good = F.coalesce(
        (F.col("_query") != "") & F.col("_limit").between(0, top) & F.col("_offset").between(0, top), F.lit(False)
    )
    others = [c for c in df.columns if c != request]
    return (
        parsed.filter(good).select(*others, *[F.col(f"_{name}").alias(name) for name in SEARCH_REQUEST.names]),
        parsed.filter(~good).select(*df.columns, F.lit("bad request").alias("reason")),
    )


def to_results(results: DataFrame) -> DataFrame:
    """JSON records (url, score, summary, title)."""
    return results.select(F.to_json(F.struct("url", "score", "summary", "title")).alias("result"))


# Fixed value: results per page of the search form.
PAGE_SIZE = 10


def page_to_offset(queries: DataFrame, page: str = "page") -> DataFrame:
    """Adds limit and offset of a numbered page; no number is the first page."""
    number = F.coalesce(F.col(page).cast("bigint"), F.lit(0).cast("bigint"))
    return queries.withColumns({"limit": F.lit(PAGE_SIZE).cast("bigint"), "offset": number * PAGE_SIZE})
