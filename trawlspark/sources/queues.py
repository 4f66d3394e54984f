"""Work queues between the stages: a folder of id records, or a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import QUEUE_MESSAGE


def write_ids(ids: DataFrame, path: str, mode: str = "append") -> None:
    """Publishes (id, event_time) rows; ``path`` names the stage."""
    ids.select("id", "event_time").write.mode(mode).parquet(path)


def read_ids(spark: SparkSession, path: str | None = None, kafka: dict | None = None, **options: str) -> DataFrame:
    """Stream of (id, event_time). The stream's checkpoint takes the place of acknowledgements."""
    if kafka is not None:
        records = spark.readStream.format("kafka").options(**kafka).load()
        return records.select(F.col("value").cast("string").alias("id"), F.col("timestamp").alias("event_time"))
    return (
        spark.readStream.schema(QUEUE_MESSAGE)
        .options(recursiveFileLookup="true", **options)
        .parquet(path)
    )
