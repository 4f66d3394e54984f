"""The cache as a log table: the last operation of a key counts, entries may expire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import last_per_key


def kv_set(keys: DataFrame, as_of: Column, ttl_s: Column | None = None) -> DataFrame:
    """Log rows that store (key, value, seq)."""
    ttl = ttl_s if ttl_s is not None else F.lit(None).cast("int")
    return keys.select("key", "value", "seq", F.lit("set").alias("op"), as_of.alias("ts"), ttl.alias("ttl_s"))


def kv_del(keys: DataFrame, as_of: Column) -> DataFrame:
    """Log rows that delete (key, seq)."""
    return keys.select(
        "key",
        F.lit(None).cast("binary").alias("value"),
        "seq",
        F.lit("del").alias("op"),
        as_of.alias("ts"),
        F.lit(None).cast("int").alias("ttl_s"),
    )


def kv_latest(log: DataFrame, as_of: Column) -> DataFrame:
    """Live entries at ``as_of`` of a log (key, op, seq, ts, ttl_s, …)."""
    current = last_per_key(log.filter(F.col("ts") <= as_of), "key", ["ts", "seq"])
    alive = F.col("ttl_s").isNull() | (F.timestamp_micros(F.unix_micros("ts") + F.col("ttl_s").cast("bigint") * 1_000_000) > as_of)
    return current.filter((F.col("op") != "del") & alive)


def kv_get(keys: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Keys with their entries, or nulls."""
    return keys.join(kv_latest(log, as_of), "key", "left")


def kv_exists(keys: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Keys that have a live entry."""
    return keys.join(kv_latest(log, as_of).select("key"), "key", "left_semi")
