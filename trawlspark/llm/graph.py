"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge (a, b); ``root`` is the smallest node of its component.

    Alternating large-star and small-star steps. Minima are combined before the shuffle, the joins back may be split
    by adaptive execution, so a node with very many edges spans tasks. Each round is stored in the shared folder; only
    two numbers per round reach the driver. Edges of a node to itself and null nodes are ignored.
    """
    known = edges.filter("a is not null and b is not null")
    up = known.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(up.filter("u > v").distinct(), label)
    seen = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select("v", "m").union(least.select("u", "m"))
        now = stored(small.toDF("u", "v").filter("u > v").distinct(), label)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"no stable components after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
