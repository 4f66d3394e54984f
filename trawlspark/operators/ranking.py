"""Row numbers inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every group.

    The rank filter lets Spark keep only ``n`` rows per group on the map side, so a hot group does not travel.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def row_number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn", partitions: int | None = None
) -> DataFrame:
    """``row_number()`` per group for groups that may be too large for one task.

    Rows are range-partitioned on keys and order together, so a hot group spans many partitions. Local numbers plus
    the group's row count in earlier partitions give the number. The layout is written once, since partition ids
    must not change between the two uses.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = durable(
        df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id())
    )
    # One row per (partition, group): as many as groups plus partitions. Ordering them per group is cheap, as one
    # group meets at most n partitions.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy("_part", *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    local = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order))
    return (
        laid.withColumn("_local", local)
        .join(offsets, ["_part", *keys])
        .withColumn(out, F.col("_local").cast("bigint") + F.col("_before"))
        .drop("_local", "_before", "_part")
    )
