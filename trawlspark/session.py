"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Run-time settings every job of this package relies on; all may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and vectors are wide: keep an Arrow batch far below a Python worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    # Id lists of a result page are pushed to Parquet as equality filters, not as one wide range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time settings of the package on a session, once; what the caller changes afterwards stays."""
    mark = "spark.trawlspark.configured"
    if spark.conf.get(mark, None) is None:
        for key, value in {**RUNTIME_CONF, mark: "true"}.items():
            spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trawlspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session in one JVM may fall back to a temporary folder; a cluster without the setting is an error, also
    one on this machine, because a machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="trawlspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df, label: str):
    """Write ``df`` as Parquet into the shared folder and read it again.

    The rows are computed once, however many branches follow, a lost executor costs no step before this one, and
    Spark knows the size of what it reads.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df):
    """Write ``df`` once to the shared folder and go on from there, so that later branches read equal rows."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)

