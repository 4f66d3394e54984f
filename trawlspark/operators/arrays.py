"""Arrays to rows and back, last value per key, pooling, and write counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def unnest(df: DataFrame, *array_cols: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays side by side as rows."""
    return df.select(*keep, F.inline(F.arrays_zip(*[F.col(c) for c in array_cols])))


def collect_arrays(df: DataFrame, key: str, order: str, *cols: str) -> DataFrame:
    """One row per key with one array per column, all in the same order. A group is one row, so keys must be fine."""
    rows = F.array_sort(F.collect_list(F.struct(order, *[c for c in cols if c != order])))
    packed = df.groupBy(key).agg(rows.alias("_rows"))
    return packed.select(key, *[F.col("_rows").getField(c).alias(c) for c in cols])


def last_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest order value per key."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")


def mean_pool(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per key. Partial sums are built before the shuffle, so a hot key costs one row per task."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(key).agg(mean.alias("_mean")).select(key, vector_to_array("_mean").alias(vector))


def cls_pool(df: DataFrame, key: str, order: str, vector: str = "embedding") -> DataFrame:
    """Vector of the first token per key."""
    return df.groupBy(key).agg(F.min_by(vector, order).alias(vector))


def write_counts(offered: DataFrame, written: DataFrame, stage: str) -> DataFrame:
    """One row: how many rows a stage offered and how many it wrote."""
    counts = offered.select(F.lit(1).alias("o"), F.lit(0).alias("w")).unionAll(
        written.select(F.lit(0).alias("o"), F.lit(1).alias("w"))
    )
    return counts.agg(
        F.coalesce(F.sum("o"), F.lit(0)).alias("rows_offered"),
        F.coalesce(F.sum("w"), F.lit(0)).alias("rows_written"),
    ).select(F.lit(stage).alias("stage"), "rows_offered", "rows_written")


def observed(df: DataFrame, name: str, failed: Column | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with a row count (and failure count) taken on the way, without an extra pass."""
    seen = Observation(name)
    bad = F.count_if(failed) if failed is not None else F.count_if(F.lit(False))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("failed")), seen
