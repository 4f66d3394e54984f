"""Mixing of sources to target weights through a multivariate-hypergeometric splitting tree (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

MAX_PASSES = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, source_no, target): all words shared 1, 2, 3, 1, ... in source order, null last.

    A target stops at ``max_passes`` times its source's size and the excess is shared again by weight. With sources in
    the order of cap over weight, the level (words per unit of weight) is the greatest of (all words - caps before) /
    (weights from here on): it rises while sources are capped and falls afterwards. One row per source, not per
    document, meets in these windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("source_no", F.row_number().over(by_name)).withColumn(
        "weight", ((F.col("source_no") - 1) % 3 + 1).cast("double")
    )
    cap = (F.lit(max_passes) * F.col("source_size")).cast("double")
    fill = Window.orderBy(cap / F.col("weight"), "source_no")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.greatest(F.lit(0.0), F.least(cap, F.col("level") * F.col("weight")))
    return leveled.select("source", "source_size", "source_no", target.alias("target"))


def split_quotas(quotas: np.ndarray, low: int, high: int, shards: int, total: int, seed: int):
    """(left quotas, right quotas, middle): blocks of a node for shards [low, high) dealt to its two halves at random.

    The draw is multivariate hypergeometric, so quotas add up exactly and each shard expects its share of every
    source. It depends on the seed and the node alone: a task that is run again deals alike.
    """
    middle = (low + high) // 2
    room = total * middle // shards - total * low // shards
    left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(quotas, room, method="marginals")
    return left, quotas - left, middle


def _split_levels(levels: int, shards: int, seed: int):
    schema = pa.schema([("low", pa.int64()), ("high", pa.int64()), ("total", pa.int64()),
                        ("nos", pa.list_(pa.int32())), ("quotas", pa.list_(pa.int64()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                todo = [(row["low"], row["high"], np.array(row["nos"], np.int32), np.array(row["quotas"], np.int64), levels)]
                while todo:
                    low, high, nos, quotas, left_levels = todo.pop()
                    if left_levels and high - low > 1 and len(nos):
                        a, b, middle = split_quotas(quotas, low, high, shards, row["total"], seed)
                        todo.append((low, middle, nos[a > 0], a[a > 0], left_levels - 1))
                        todo.append((middle, high, nos[b > 0], b[b > 0], left_levels - 1))
                    elif len(nos):
                        node = {"low": low, "high": high, "total": row["total"], "nos": nos.tolist(), "quotas": quotas.tolist()}
                        yield pa.RecordBatch.from_pylist([node], schema=schema)

    return split


def shard_quotas(totals: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, shard, n): the splitting tree over (source_no, draws), upper levels first, then each node by itself."""
    shape = "low bigint, high bigint, total bigint, nos array<int>, quotas array<bigint>"
    gathered = totals.filter("draws > 0").agg(
        F.sort_array(F.collect_list(F.struct("source_no", "draws"))).alias("s"), F.sum("draws").alias("total")
    )
    root = gathered.filter("total > 0").select(
        F.lit(0).cast("bigint").alias("low"), F.lit(shards).cast("bigint").alias("high"), "total",
        F.col("s.source_no").alias("nos"), F.col("s.draws").alias("quotas"),
    )
    depth = max(1, (shards - 1).bit_length())
    upper = root.mapInArrow(_split_levels(depth // 2, shards, seed), shape)
    leaves = upper.repartition("low").mapInArrow(_split_levels(depth - depth // 2, shards, seed), shape)
    pairs = leaves.select(F.col("low").cast("int").alias("shard"), F.explode(F.arrays_zip("nos", "quotas")).alias("q"))
    return pairs.select(F.col("q.nos").alias("source_no"), "shard", F.col("q.quotas").alias("n"))


NUMBERED = (
    "source_no int, source string, source_size bigint, target double, full int, rest double, block int, words bigint, "
    "pass int, turn bigint, drawn boolean"
)


def fill(words: list[int], rest: float) -> list[bool]:
    """Which of the blocks, in their order, are taken so that their words stay within ``rest``; empty ones are not."""
    out = []
    for n in words:
        fits = 0 < n <= rest
        rest -= n if fits else 0
        out.append(fits)
    return out


def _draw_pass(rows: pa.Table) -> pa.Table:
    """Blocks of one pass over one source in their drawn order, with number and whether they are read."""
    rows = rows.sort_by([("mark", "ascending"), ("block", "ascending")]).drop_columns(["mark"])
    number, full, rest = (rows.column(c)[0].as_py() for c in ("pass", "full", "rest"))
    drawn = [True] * len(rows) if number < full else fill(rows.column("words").to_pylist(), rest)
    turn = pa.array(number * len(rows) + np.arange(len(rows)), pa.int64())
    return rows.append_column("turn", turn).append_column("drawn", pa.array(drawn, pa.bool_()))


def mix_sources(
    docs: DataFrame, seed: int = 7, blocks: int = 4096, shards: int = 64, source: str = "source", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, source, size, source_size, target, taken, draws).

    ``draws`` lists the (pass, shard) pairs in which the mix reads the document, ``taken`` its words times their
    number, at most three times its size. Documents fall into ``blocks`` blocks per source by a hash of their id. A
    target is so many whole passes over the source's blocks plus blocks of one more pass, in an order drawn anew for
    each pass: each block that still fits is taken, others are passed over. One closing document, the one whose size
    comes nearest, fills the gap. The
    splitting tree deals exact numbers of these block draws to the shards, and shard after shard takes the next blocks
    of the permuted order, so no two shards share a draw. Inside a shard ``shard_rows`` shuffles.

    Null and empty texts have size 0. Null sources form one source, the last. Repeated rows share an id, so a block:
    they are drawn alike. A null id never closes a gap. Only ids, sources and sizes are shuffled; tables of blocks have
    ``blocks`` rows per source at any size of the input. An empty table gives an empty result.
    """
    rows = stored(
        docs.select(
            docs["doc_id"].cast("bigint").alias("doc_id"),
            docs[source].cast("string").alias("source"),
            word_count(docs[text]).alias("size"),
            F.pmod(F.xxhash64(F.lit(seed), docs["doc_id"].cast("bigint")), F.lit(blocks)).cast("int").alias("block"),
        ),
        "sizes",
    )
    filled = stored(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    targets = source_targets(filled.groupBy("source").agg(F.sum("words").alias("source_size")))
    passes = F.least(F.lit(MAX_PASSES), F.floor(F.col("target") / F.col("source_size"))).cast("int")
    full = F.when(F.col("source_size") > 0, passes).otherwise(0)
    goals = targets.withColumn("full", full).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))

    # Order of the blocks in each pass; the pass after the full ones takes every block that still fits the rest.
    b, g = filled.alias("b"), goals.alias("g")
    joined = b.join(g, F.col("b.source").eqNullSafe(F.col("g.source"))).select("g.*", "b.block", "b.words")
    turns = joined.select(
        "source_no", "source", "source_size", "target", "full", "rest", "block", "words",
        F.explode(F.sequence(F.lit(0), F.least(F.col("full"), F.lit(MAX_PASSES - 1)))).alias("pass"),
    )
    mark = F.xxhash64(F.lit(seed), "source_no", "pass", "block")
    numbered = stored(turns.withColumn("mark", mark).groupBy("source_no", "pass").applyInArrow(_draw_pass, NUMBERED), "turns")
    drawn = numbered.filter("drawn")
    # Blocks left out (they have no words) would leave holes, so draws are numbered once more.
    draws = drawn.withColumn("turn", F.row_number().over(Window.partitionBy("source_no").orderBy("turn")) - 1)

    quotas = shard_quotas(drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("draws")), shards, seed)
    upto = F.sum("n").over(Window.partitionBy("source_no").orderBy("shard"))
    ranges = quotas.withColumn("end", upto).select(
        "source_no", "shard", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("turn")
    )
    dealt = draws.join(ranges, ["source_no", "turn"]).groupBy("source_no", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws")
    )

    # The closing document of each source: outside the blocks of its last pass, nearest in size to what is missing.
    last = F.col("pass") == F.col("full")
    gaps = numbered.groupBy("source_no").agg(
        F.first("source").alias("source"), F.first("rest").alias("rest"),
        F.coalesce(F.sum(F.when(last & F.col("drawn"), F.col("words"))), F.lit(0)).alias("got"),
    )
    plan = (
        numbered.groupBy("source_no", "source", "source_size", "target", "full", "block")
        .agg(F.max(last & F.col("drawn")).alias("in_last"))
        .join(gaps.select("source_no", (F.col("rest") - F.col("got")).alias("gap")), "source_no")
        .join(dealt, ["source_no", "block"], "left")
    )
    plan = stored(plan.withColumnsRenamed({"source": "plan_source", "block": "plan_block"}), "mix-plan")
    at = (rows["block"] == plan["plan_block"]) & rows["source"].eqNullSafe(plan["plan_source"])
    off = F.abs(F.col("size") - F.col("gap"))
    free = rows.join(plan, at).filter((F.col("full") < MAX_PASSES) & ~F.col("in_last") & (off < F.col("gap")) & F.col("doc_id").isNotNull())
    nearest = F.min(F.struct(off.alias("off"), F.xxhash64(F.lit(seed), "doc_id").alias("h"), "doc_id")).alias("s")
    closing = free.groupBy("source_no").agg(nearest).select("source_no", F.col("s.doc_id").alias("closing_id"))
    ready = plan.join(stored(closing, "closing"), "source_no", "left")

    at = (rows["block"] == ready["plan_block"]) & rows["source"].eqNullSafe(ready["plan_source"])
    closes = F.coalesce(F.col("doc_id") == F.col("closing_id"), F.lit(False))
    extra = F.struct(F.col("full").alias("pass"), F.pmod(F.xxhash64(F.lit(seed), "source_no"), F.lit(shards)).cast("int").alias("shard"))
    own = F.coalesce("draws", F.array().cast("array<struct<pass:int,shard:int>>"))
    every = F.when(closes, F.concat(own, F.array(extra))).otherwise(own)
    out = rows.join(ready, at).select("doc_id", "source", "size", "source_size", "target", every.alias("draws"))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), "draws"
    )


def shard_rows(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """One row per draw, shards in partitions of their own, shuffled inside each: (shard, pass, and the other columns)."""
    each = mixed.withColumn("draw", F.explode("draws")).drop("draws")
    flat = each.select(F.col("draw.shard").alias("shard"), F.col("draw.pass").alias("pass"), *[c for c in each.columns if c != "draw"])
    mark = F.xxhash64(F.lit(seed), "shard", "pass", "doc_id")
    return flat.repartition("shard").sortWithinPartitions("shard", mark)
