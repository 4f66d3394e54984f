"""One query per operator of this folder over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import alignment, bytenet, decontaminate, html, licenses, lines, mixing, passages, periods, quality, simhash, tokens, toxicity
from .common import table

SQL = {"op10_license_scan": licenses.SQL, "op4_quality_rules": quality.SQL, "op8_line_dedup": lines.SQL}


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("source")


def op2_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.from_either_side(passages.shared_passages(table(spark, sf_dir, "documents"), before=None))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("path", licenses.fixture_path())
    return licenses.scan_licenses(docs).drop("lines")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text", periods.with_repeats(F.col("doc_id"), F.col("text")))
    return periods.run_digests(periods.find_runs(docs))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytenet.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f):
        return lambda spark, sf_dir: f(configure(spark), sf_dir)

    return {name: bind(f) for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
