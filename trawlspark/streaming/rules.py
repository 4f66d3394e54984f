"""Stateful rules on streams: visits, cached pages, request rate."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.frontier import PAYLOAD_TTL, VISIT_TTL

NO_PAGE = "no cached page for the id"


def visited_stream(df: DataFrame, url: str = "url", ts: str = "ts", ttl: str = VISIT_TTL) -> DataFrame:
    """First fetch of each URL within the life of a visit. Which of several close fetches stays is not defined."""
    return df.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([url])


def payload_stream(ids: DataFrame, payloads: DataFrame, ttl: str = PAYLOAD_TTL) -> DataFrame:
    """Id messages (id, get_ts) with the cached page (id, put_ts, …) if it is still alive. Late ids find nothing."""
    left = ids.withWatermark("get_ts", ttl).alias("i")
    right = payloads.withWatermark("put_ts", ttl).alias("p")
    alive = (
        (F.col("i.id") == F.col("p.id"))
        & (F.col("i.get_ts") >= F.col("p.put_ts"))
        & (F.col("i.get_ts") < F.col("p.put_ts") + F.expr(f"INTERVAL {ttl}"))
    )
    rest = [F.col(f"p.{c}") for c in payloads.columns if c != "id"]
    return left.join(right, alive).select("i.*", *rest)


def payload_or_error_stream(ids: DataFrame, payloads: DataFrame, ttl: str = PAYLOAD_TTL, delay: str = "0 seconds") -> DataFrame:
    """Every id message (id, get_ts) once: with the cached page that was alive at its time, or with a ``reason``.

    An outer join of two streams: an id without a page comes out when the watermark has passed all pages it could have
    met, and its state goes then. The latest page put before the id's time is not singled out: an id that was put twice
    within the life of a page comes out with both. ``delay`` is how long either side waits for rows out of order.
    """
    left = ids.withWatermark("get_ts", delay).alias("i")
    right = payloads.withWatermark("put_ts", delay).alias("p")
    alive = (
        (F.col("i.id") == F.col("p.id"))
        & (F.col("p.put_ts") <= F.col("i.get_ts"))
        & (F.col("p.put_ts") > F.col("i.get_ts") - F.expr(f"INTERVAL {ttl}"))
    )
    rest = [F.col(f"p.{c}") for c in payloads.columns if c != "id"]
    reason = F.when(F.col("p.id").isNull(), F.lit(NO_PAGE)).alias("reason")
    return left.join(right, alive, "left_outer").select("i.*", *rest, reason)


def _spaced(df: DataFrame, key: str, wait_us: int, strict: bool, flag: str) -> DataFrame:
    """Per key in time order: a row passes when its distance to the last passed row exceeds ``wait_us``.

    Only the time of the last passed row is kept per key, so state does not grow with the rows. Rows of one key
    that arrive in one trigger are handled together; trigger limits and the per-host queue batch bound them.
    """
    columns = [f.name for f in df.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", {flag} boolean"

    def step(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "seq"], kind="stable")
        last = state.get[0] if state.exists else None
        passed = []
        for at in rows["ts"].astype("datetime64[us]").astype("int64"):
            ok = last is None or (at - last > wait_us if strict else at - last >= wait_us)
            passed.append(ok)
            last = int(at) if ok else last
        state.update((last,))
        yield rows[columns].assign(**{flag: passed})

    return df.groupBy(key).applyInPandasWithState(
        step, schema, "last_us bigint", "append", GroupStateTimeout.NoTimeout
    )


def rate_limit_stream(df: DataFrame, interval_s: float, key: str = "host") -> DataFrame:
    """Rows (key, ts, seq, …) with ``accepted``: more than the interval since the key's last accepted row."""
    return _spaced(df, key, int(interval_s * 1_000_000), True, "accepted")


def first_visit_stream(df: DataFrame, ttl_s: int = 7 * 86400, key: str = "url") -> DataFrame:
    """Rows (key, ts, seq, …) with ``fresh``: exact form of the visit rule, a fetch after the visit's life passes."""
    return _spaced(df, key, ttl_s * 1_000_000, False, "fresh")
