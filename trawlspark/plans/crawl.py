"""One round of the crawl, as tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.frontier import BATCH_PER_HOST, TOO_FAST, admit, dequeue, gate_content_type, requeue
from ..operators.robots import DEFAULT_AGENT
from ..session import durable
from ..sources.messages import to_messages


class CrawlRound(NamedTuple):
    """Outputs of a round; every one is a table the caller stores."""

    judged: DataFrame  # dequeued rows with ok and reason
    messages: DataFrame  # (id, message) for the parser
    visits: DataFrame  # (url, visited_at) to add
    errors: DataFrame  # responses with an unreadable type, without body
    failed: DataFrame  # admitted rows without a response
    frontier: DataFrame  # rows that stay, rate-limited ones included


def crawl_round(
    frontier: DataFrame,
    sites: DataFrame,
    rules: DataFrame,
    visited: DataFrame,
    responses: DataFrame,
    as_of: Column,
    agent: str = DEFAULT_AGENT,
    batch: int = BATCH_PER_HOST,
    round_s: float | None = None,
) -> CrawlRound:
    """Dequeue, admit, and gate the responses (url, status, content_type, body) of the admitted URLs.

    The judged batch is narrow and has at most ``batch`` rows per host; it is stored once, as all outputs use it.
    """
    taken, rest = dequeue(frontier, sites, batch)
    judged = durable(admit(taken, sites, rules, visited, as_of, agent, round_s, max_per_host=batch))
    admitted = judged.filter("ok").select("url", "depth")
    # Bodies are joined for pages alone; the other outputs need the header of an answer only.
    pages = gate_content_type(responses)[0].join(admitted, "url")
    _, seen, errors = gate_content_type(admitted.join(responses.drop("body"), "url"))
    deferred = judged.filter(F.col("reason") == TOO_FAST).select(*frontier.columns)
    return CrawlRound(
        judged,
        to_messages(pages.withColumnRenamed("body", "content"), as_of),
        seen.select("url", as_of.alias("visited_at")),
        errors,
        admitted.join(responses.select("url"), "url", "left_anti"),
        requeue(rest, deferred),
    )
