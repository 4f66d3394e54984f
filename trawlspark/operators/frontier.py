"""The crawl frontier: scope, queue batches, visits, admission, pacing, new links, response gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import url_host, url_path, valid_urls
from .ranking import first_per_group, row_number_within
from .robots import DEFAULT_AGENT, host_rules, path_allowed

# Queue size per host and overall, life of a visit and of a cached page.
BATCH_PER_HOST = 100
VISIT_TTL = "7 days"
PAYLOAD_TTL = "10 minutes"

# Outcome texts of the admission test, in the order of the tests.
NO_HOST = "No host found"
NOT_CONFIGURED = "host not found in configured sites"
TOO_DEEP = "site depth reached"
FORBIDDEN = "not allowed by robots.txt"
VISITED = "url exists in redis"
TOO_FAST = "rate limit exceeded"
PASSED = "all checks passed"


def _ttl(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def in_scope(urls: DataFrame, sites: DataFrame) -> DataFrame:
    """URLs whose host is configured; URLs without a host drop out."""
    return urls.join(sites.select("host"), "host", "left_semi")


def out_of_scope(urls: DataFrame, sites: DataFrame) -> DataFrame:
    return urls.join(sites.select("host"), "host", "left_anti")


def next_depth(depth: Column) -> Column:
    return depth + F.lit(1)


def enqueue_links(frontier: DataFrame, links: DataFrame, as_of: Column) -> DataFrame:
    """Rows to append: links (url, host, depth) not in the frontier yet, one per URL, at its lowest depth.

    The host belongs to the URL, so grouping by both keeps one row per URL and lets the hash aggregate do it ahead of
    the shuffle: a link found on very many pages travels once per task.
    """
    fresh = links.groupBy("url", "host").agg(F.min("depth").alias("depth"))
    return fresh.join(frontier.select("url"), "url", "left_anti").select(
        "url", "host", "depth", as_of.alias("created_at"), as_of.alias("updated_at")
    )


def dequeue(frontier: DataFrame, sites: DataFrame, batch: int = BATCH_PER_HOST) -> tuple[DataFrame, DataFrame]:
    """(taken, rest): the oldest rows of each configured host leave the frontier; what is no URL is not handed on."""
    oldest = [F.col("created_at"), F.col("url_id")]
    taken = first_per_group(in_scope(frontier, sites), ["host"], oldest, batch).select(*frontier.columns)
    return valid_urls(taken), frontier.join(taken.select("url_id"), "url_id", "left_anti")


def refill(held: DataFrame, taken: DataFrame, cap: int = BATCH_PER_HOST) -> DataFrame:
    """Work list of a round: nothing is added once ``cap`` URLs are held."""
    full = F.lit(held.limit(cap).count() >= cap)
    return held.unionByName(taken.filter(~full))


def requeue(frontier: DataFrame, deferred: DataFrame) -> DataFrame:
    """Rate-limited rows go back to the tail."""
    return frontier.unionByName(deferred)


def active_visits(visited: DataFrame, as_of: Column, ttl: str = VISIT_TTL) -> DataFrame:
    return visited.filter(F.col("visited_at") + _ttl(ttl) > as_of).select("url").distinct()


def not_visited(frontier: DataFrame, visited: DataFrame, as_of: Column, ttl: str = VISIT_TTL) -> DataFrame:
    """Rows whose URL was not fetched within the life of a visit."""
    return frontier.join(active_visits(visited, as_of, ttl), "url", "left_anti")


def pace_schedule(
    frontier: DataFrame, sites: DataFrame, start: Column, max_per_host: int | None = None
) -> DataFrame:
    """Adds ``fetch_at``: row k of a host may be fetched k intervals after ``start``.

    ``max_per_host`` states that no host has more rows (as after ``dequeue``); then one window does. Else hosts may
    have any size and are numbered across partitions.
    """
    rows = frontier.withColumn("host", url_host("url")) if "host" not in frontier.columns else frontier
    order = [F.col("created_at"), F.col("url_id")]
    # Hosts out of scope are left behind before anything is numbered or stored.
    timed = rows.join(sites.select("host", "interval_s"), "host")
    if max_per_host is None:
        ranked = row_number_within(timed, ["host"], order, "_slot")
    else:
        ranked = timed.withColumn("_slot", F.row_number().over(Window.partitionBy("host").orderBy(*order)))
    wait = (F.col("_slot") * F.col("interval_s") * 1000000).cast("bigint")
    return ranked.withColumn("fetch_at", F.timestamp_micros(F.unix_micros(start) + wait)).drop("_slot", "interval_s")


def admit(
    frontier: DataFrame,
    sites: DataFrame,
    rules: DataFrame,
    visited: DataFrame,
    as_of: Column,
    agent: str = DEFAULT_AGENT,
    round_s: float | None = None,
    max_per_host: int | None = None,
    fallback_star: bool = False,
    ignore_empty: bool = False,
) -> DataFrame:
    """Adds ``ok`` and ``reason``: the first test that fails names the reason.

    With ``round_s`` a host gets as many URLs as fit that many seconds under its interval, oldest first; the others
    exceed the rate limit. Without it no rate applies.
    """
    site = sites.select("host", F.col("depth").alias("_limit"), F.lit(True).alias("_site"), "interval_s")
    rows = (
        frontier.drop("host")
        .withColumn("host", url_host("url"))
        .join(site, "host", "left")
        .join(host_rules(rules, agent, fallback_star, ignore_empty), "host", "left")
        .join(active_visits(visited, as_of).withColumn("_seen", F.lit(True)), "url", "left")
    )
    reason = (
        F.when(F.col("host").isNull(), NO_HOST)
        .when(F.col("_site").isNull(), NOT_CONFIGURED)
        .when(F.col("depth") >= F.col("_limit"), TOO_DEEP)
        .when(~path_allowed(url_path("url"), F.col("allow"), F.col("disallow")), FORBIDDEN)
        .when(F.col("_seen"), VISITED)
        .otherwise(PASSED)
    )
    judged = rows.withColumn("reason", reason).select(*[c for c in frontier.columns if c != "host"], "host", "reason", "interval_s")
    if round_s is not None:
        passed = judged.filter(F.col("reason") == PASSED)
        order = [F.col("created_at"), F.col("url_id")]
        if max_per_host is None:
            slots = row_number_within(passed, ["host"], order, "_slot")
        else:
            slots = passed.withColumn("_slot", F.row_number().over(Window.partitionBy("host").orderBy(*order)))
        late = F.col("_slot") * F.col("interval_s") > F.lit(float(round_s))
        slots = slots.withColumn("reason", F.when(late, TOO_FAST).otherwise(PASSED)).drop("_slot")
        judged = judged.filter(F.col("reason") != PASSED).unionByName(slots)
    return judged.drop("interval_s").withColumn("ok", F.col("reason") == PASSED)


def gate_content_type(responses: DataFrame, content_type: str = "content_type") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, visited, errors) of fetched responses.

    Text becomes a page and is marked visited; other types and answers without a type are only marked visited; a
    header that is no media type is an error and not marked. The status plays no part.
    """
    token = r"[!#$%&'*+.^_`|~0-9A-Za-z-]+"
    header = F.col(content_type)
    broken = F.coalesce(~header.rlike(rf"^{token}/{token}\s*(;.*)?$"), F.lit(False))
    is_text = F.coalesce(F.lower(F.split_part(header, F.lit("/"), F.lit(1))) == "text", F.lit(False))
    return (
        responses.filter(~broken & is_text),
        responses.filter(~broken),
        responses.filter(broken),
    )


def lookup_payloads(ids: DataFrame, payloads: DataFrame, ttl: str = PAYLOAD_TTL) -> tuple[DataFrame, DataFrame]:
    """(found, missing): id messages (id, get_ts) against cached pages (id, put_ts, …) that live for ``ttl``.

    A page is there from the time it is put; an id read earlier finds nothing.
    """
    pages = payloads.withColumnRenamed("id", "_page_id")
    alive = (
        (F.col("id") == F.col("_page_id"))
        & (F.col("get_ts") >= F.col("put_ts"))
        & (F.col("get_ts") < F.col("put_ts") + _ttl(ttl))
    )
    missing = ids.join(pages, alive, "left_anti").withColumn("reason", F.lit("document not found"))
    return ids.join(pages, alive).drop("_page_id"), missing
