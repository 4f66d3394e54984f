"""From raw documents to a training mix: each stage reads what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawlspark.llm import decontaminate, lines, mixing, simhash, toxicity
from trawlspark.llm.common import stored, table
from trawlspark.session import configure


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after the text has changed, where the table has that column."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go (operator 6)."""
    return toxicity.drop_toxic(docs, table(configure(spark), sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has go; every document stays (operator 8)."""
    configure(spark)
    return _recounted(lines.drop_repeated_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id (operator 3)."""
    configure(spark)
    return simhash.keep_one_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go (operator 9)."""
    return decontaminate.drop_contaminated(docs, table(configure(spark), sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How the mix reads each document (operator 1); ``mixing.shard_rows`` turns this into shuffled shards."""
    configure(spark)
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("source_mix", mix),
]

# Learned scores, bit distances, fuzzy alignment and seeded draws have no SQL form; tests/llm checks the stages against
# plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
