"""Site configuration: which hosts are crawled, how deep and how fast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normal_url, robots_url, url_host
from ..schemas import SITE_CONFIG
from .arrays import last_per_key

# Fixed value: seconds between two requests of a site that names no rate.
DEFAULT_INTERVAL_S = 0.5


def request_interval(rps: Column) -> Column:
    """Seconds between requests: 1/rps, else the default. A rate of zero is an error."""
    bad = F.raise_error(F.lit("rps must be at least 1")).cast("double")
    return F.when(rps.isNull(), F.lit(DEFAULT_INTERVAL_S)).when(rps <= 0, bad).otherwise(F.lit(1.0) / rps)


def site_entries(configs: DataFrame, json: str = "config", order: str | None = None) -> DataFrame:
    """All entries of JSON site lists in file order, repeated hosts included. A text without "sites" is an error.

    URLs are normalised here, so a configured site has the host and the spelling that resolved links have.
    """
    sites = F.from_json(F.col(json), SITE_CONFIG).getField("sites")
    missing = F.raise_error(F.lit('a site list has no entry "sites"')).cast(SITE_CONFIG["sites"].dataType)
    file_no = F.col(order) if order else F.lit(0)
    return (
        configs.select(file_no.alias("file_no"), F.coalesce(sites, missing).alias("_sites"))
        .select("file_no", F.posexplode("_sites").alias("pos", "_site"))
        .select("file_no", "pos", "_site.*")
        .withColumn("url", F.coalesce(normal_url("url"), F.col("url")))
        .withColumn("host", url_host("url"))
    )


def parse_sites(configs: DataFrame, json: str = "config", order: str | None = None) -> DataFrame:
    """One row per host: (host, url, depth, rps, interval_s). The last entry of a host wins."""
    entries = site_entries(configs, json, order).filter(F.col("host").isNotNull())
    latest = last_per_key(entries, "host", ["file_no", "pos"])
    return latest.select("host", "url", "depth", "rps", request_interval(F.col("rps")).alias("interval_s"))


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site table of the JSON files under ``path``; of files that name one host the last by path wins."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("config"), F.col("_metadata.file_path").alias("file"))
    return parse_sites(files, order="file")


def seed_frontier(entries: DataFrame) -> DataFrame:
    """Every configured URL with a host at depth 0; repeated hosts stay."""
    return entries.filter(F.col("host").isNotNull()).select("url", "host", F.lit(0).alias("depth"))


def robots_targets(entries: DataFrame) -> DataFrame:
    """Where the rules of each web site are found."""
    return entries.select("host", robots_url("url").alias("robots_url")).filter(F.col("robots_url").isNotNull())
