"""Raw pages to title, text and links."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.htmltext import page_parts
from ..functions.text import clean_text
from ..functions.urls import url_host
from ..functions.weburl import page_links
from .frontier import next_depth

_LIST = T.ArrayType(T.StringType())
_PAGE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("hrefs", _LIST),
        T.StructField("links", _LIST),
    ]
)


@F.pandas_udf(_PAGE)
def _read_page(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    rows = []
    for text, url in zip(html, base):
        if text is None:
            rows.append((None, None, None, None))
            continue
        title, body, hrefs = page_parts(text)
        rows.append((title, body, hrefs, page_links(url, hrefs)))
    return pd.DataFrame(rows, columns=["title", "body", "hrefs", "links"])


@F.pandas_udf(_LIST)
def _resolve(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    return pd.Series([page_links(b, h) if h is not None else None for b, h in zip(base, hrefs)])


# Filters on a result would be pushed below the call and read every page a second time; Spark keeps its hands off
# functions it may not repeat.
_read_page = _read_page.asNondeterministic()
_resolve = _resolve.asNondeterministic()


def extract_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Adds title, body, hrefs and resolved links. HTML is read once, in Arrow batches; ``html`` itself is dropped."""
    kept = [c for c in pages.columns if c not in (html, "title", "body", "hrefs", "links")]
    return pages.select(*kept, _read_page(F.col(html), F.col(url)).alias("_page")).select(*kept, "_page.*")


def split_empty(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, rejected): a page whose body text is exactly empty gives neither a document nor links."""
    empty = F.coalesce(F.col("body") == "", F.lit(True))
    return extracted.filter(~empty), extracted.filter(empty).withColumn("reason", F.lit("page without body text"))


def page_content(extracted: DataFrame) -> DataFrame:
    """Adds ``content``: the cleaned title and body."""
    return extracted.withColumn("content", clean_text(F.concat(F.col("title"), F.lit(" "), F.col("body"))))


def resolve_links(df: DataFrame, base: str, hrefs: str, out: str = "links") -> DataFrame:
    """Adds the absolute URLs of an array of links; order and duplicates are kept."""
    return df.withColumn(out, _resolve(F.col(base), F.col(hrefs)))


def link_rows(extracted: DataFrame, key: str, depth: str = "depth") -> DataFrame:
    """One row per link: (key, pos, url, host, depth), one level below the page."""
    return (
        extracted.select(key, next_depth(F.col(depth)).alias("depth"), F.posexplode("links").alias("pos", "url"))
        .select(key, "pos", "url", url_host("url").alias("host"), "depth")
    )


def split_invalid(messages: DataFrame, id_col: str = "id", text: str = "content") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) with a reason: an empty id, a missing document or an empty text is an error."""
    reason = (
        F.when(F.coalesce(F.col(id_col).cast("string"), F.lit("")) == "", "empty id")
        .when(F.col(text).isNull(), "document not found")
        .when(F.col(text) == "", "empty text")
    )
    marked = messages.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())
