"""URL parts as native columns, and the request-side URL rules."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .weburl import absolute_url

HOST_PATTERN = (
    r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
    r"(\[[0-9A-Fa-f:.]+\]|[^/?#:\s\[\]]+)(?::[0-9]*)?(?:[/?#]|$)"
)
PATH_PATTERN = r"^[^:/?#]+://[^/?#]*([^?#]*)"
SCHEME_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_host(url) -> Column:
    """Lower-cased host; null for URLs without one."""
    return F.lower(F.nullif(F.regexp_extract(_col(url), HOST_PATTERN, 1), F.lit("")))


def url_path(url) -> Column:
    """Path without query and fragment; "/" when the URL stops after the host."""
    path = F.regexp_extract(_col(url), PATH_PATTERN, 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_scheme(url) -> Column:
    return F.lower(F.regexp_extract(_col(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def is_valid_url(url) -> Column:
    """An absolute URL; http and https also need a host."""
    u = _col(url)
    absolute = u.rlike(SCHEME_PATTERN)
    web = u.rlike(r"^(?i)https?:")
    return F.coalesce(absolute & (~web | url_host(u).isNotNull()), F.lit(False))


def valid_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.filter(is_valid_url(url))


@F.pandas_udf(StringType())
def _normal(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: None if u is None else absolute_url(u))


def normal_url(url) -> Column:
    """The one spelling of a URL that links are resolved to (ASCII host in lower case, no default port, a path).

    Null for what is no URL. Needed once, where a URL enters: site lists, answers and visits.
    """
    return _normal(_col(url))


def robots_url(url) -> Column:
    """Address of the rules file of a site: scheme, host, /robots.txt. Null for other schemes."""
    host = url_host(url)
    return F.when(
        url_scheme(url).startswith("http") & host.isNotNull(),
        F.concat(url_scheme(url), F.lit("://"), host, F.lit("/robots.txt")),
    )


def query_to_param(query) -> Column:
    """Search text as a URL parameter: each blank character becomes a plus sign."""
    return F.regexp_replace(_col(query), r"\s", "+")
