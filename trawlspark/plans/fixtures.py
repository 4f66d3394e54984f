"""Inputs derived from the test tables; plans.oracles holds the same definitions as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..functions.urls import url_host
from ..operators.pages import extract_pages, link_rows
from ..operators.robots import DEFAULT_AGENT

T0 = "timestamp'2024-01-01 00:00:00'"


def t0():
    return F.expr(T0)


def as_of():
    return F.expr(f"{T0} + INTERVAL 8 DAYS")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ``key`` to as many tasks as the input has splits or the session has cores, at any size."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()), key)


class Inputs:
    """The tables of one folder and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One read, and so one look at the file footers, per table."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._read[name]

    def spread(self, name: str, key: str) -> DataFrame:
        """The table dealt over the cores by ``key``: the test files are one row group each, and so one task."""
        return dealt(self.table(name), key)

    def stream(self, name: str, **options: str) -> DataFrame:
        schema = self.table(name).schema
        reader = self.spark.readStream.schema(schema).options(**options)
        return reader.option("pathGlobFilter", "*.parquet").parquet(f"{self.dir}/{name}.parquet*")

    def chunks(self, null_docs: bool = False) -> DataFrame:
        v, start = F.col("vec_id"), (F.col("vec_id") % 5) * 200
        kind = v % 50
        doc = F.expr("vec_id div 5")
        return self.table("embeddings").select(
            v.alias("chunk_id"),
            (F.when(v % 100 != 0, doc) if null_docs else doc).alias("doc_id"),
            F.when(kind == 9, None).when(kind == 7, start + 400).otherwise(start).alias("chunk_start"),
            F.when(kind == 9, None).when(kind == 7, start).when(kind == 11, 10000000).otherwise(start + 400)
            .cast("bigint").alias("chunk_end"),
            "embedding",
        )

    def documents(self) -> DataFrame:
        """Document table: the title is the first three words."""
        return self.table("documents").select(
            "doc_id",
            F.concat(F.lit("http://d/"), F.col("doc_id"), F.lit("/")).alias("url"),
            F.col("text").alias("content"),
            F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.substring_index("text", " ", 3)).alias("title"),
        )

    def query_vectors(self, n: int = 5) -> DataFrame:
        vectors = self.table("embeddings").filter(F.col("vec_id") < n).select(
            F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector")
        )
        texts = self.table("documents").filter(F.col("doc_id") < n).select(
            F.col("doc_id").alias("query_id"), F.substring_index("text", " ", 5).alias("query")
        )
        return vectors.join(texts, "query_id")

    def hosts(self) -> DataFrame:
        return self.table("pages").select(url_host("url").alias("host")).distinct()

    def sites(self) -> DataFrame:
        size = F.length("host")
        return self.hosts().filter(F.col("host").endswith(".com")).select(
            "host",
            F.when(size % 5 != 0, 2 + size % 2).alias("depth"),
            (1 + size % 2).alias("rps"),
            (F.lit(1.0) / (1 + size % 2)).alias("interval_s"),
        )

    def site_configs(self) -> DataFrame:
        """One site list per page: the page itself and its host's root; rate and depth are left out at times."""
        p = F.col("page_id")
        own = F.struct(
            "url",
            F.when(p % 3 != 0, (p % 4).cast("int")).alias("depth"),
            F.when(p % 5 != 0, (1 + p % 4).cast("int")).alias("rps"),
        )
        root = F.struct(
            F.concat(F.lit("https://"), url_host("url"), F.lit("/")).alias("url"),
            F.lit(2).alias("depth"),
            (1 + p % 2).cast("int").alias("rps"),
        )
        sites = F.when(p % 2 == 0, F.array(own, root)).otherwise(F.array(own))
        return self.table("pages").select(p.alias("page_id"), F.to_json(F.struct(sites.alias("sites"))).alias("config"))

    def parsed_pages(self) -> DataFrame:
        return extract_pages(self.spread("pages", "page_id"))

    def links(self) -> DataFrame:
        pages = self.parsed_pages().withColumn("depth", (F.col("page_id") % 3).cast("int"))
        return link_rows(pages, "page_id")

    def frontier(self) -> DataFrame:
        return self.table("pages").select(
            F.col("page_id").alias("url_id"),
            "url",
            url_host("url").alias("host"),
            (F.col("page_id") % 4).cast("int").alias("depth"),
            F.expr(f"{T0} + make_dt_interval(0, 0, int(page_id % 60))").alias("created_at"),
        )

    def visited(self) -> DataFrame:
        return self.table("pages").filter(F.col("page_id") % 5 == 0).select(
            "url", F.expr(f"{T0} + make_dt_interval(int(page_id % 12))").alias("visited_at")
        )

    def robots(self) -> DataFrame:
        kind = F.length("host") % 6
        body = (
            F.when(kind == 0, F.lit(f"User-agent: {DEFAULT_AGENT}\nAllow: /en/\nDisallow: /\n"))
            .when(kind == 1, F.lit("# all\nUser-agent: *\nDisallow: /\n"))
            .when(kind == 2, F.lit(f"Disallow: /x\nUser-agent: {DEFAULT_AGENT}\r\nDisallow:\r\n"))
            .when(kind == 3, F.lit(f"User-agent: a\nUser-agent: {DEFAULT_AGENT}\nDisallow: /fr:8/x\n Allow: /\n"))
            .when(kind == 4, F.lit(f"user-agent: {DEFAULT_AGENT}\nDisallow: /\n"))
            .otherwise(F.lit(f"User-agent: {DEFAULT_AGENT}\nDisallow: /\n"))
        )
        return self.hosts().select("host", F.when(kind == 5, 404).otherwise(200).alias("status"), body.alias("body"))

    def responses(self) -> DataFrame:
        kind = F.col("page_id") % 5
        content_type = (
            F.when(kind == 0, "text/html; charset=utf-8").when(kind == 1, "text/plain").when(kind == 2, "image/png")
            .when(kind == 4, "bad")
        )
        return self.table("pages").select("url", F.lit(200).alias("status"), content_type.alias("content_type"), F.col("html").alias("body"))

    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    def payloads(self) -> tuple[DataFrame, DataFrame]:
        """(ids, payloads) of the cache lookups."""
        e = self.events()
        get_ts = F.expr("ts + make_dt_interval(0, 0, int(event_id % 20 - 3))")
        return (
            e.select(F.col("event_id").alias("id"), get_ts.alias("get_ts")),
            e.select(F.col("event_id").alias("id"), F.col("ts").alias("put_ts"), "value"),
        )

    def kv_log(self) -> DataFrame:
        return self.events().select(
            F.col("user_id").alias("key"),
            F.when(F.col("event_type") == "error", "del").otherwise("set").alias("op"),
            F.col("event_id").alias("seq"),
            F.expr("ts + make_dt_interval(0, 0, 0, (event_id % 10) / 10)").alias("ts"),
            F.when(F.col("event_type") == "view", 604800).alias("ttl_s"),
            F.col("value"),
        )

    def docs_old_new(self) -> tuple[DataFrame, DataFrame]:
        base = self.table("documents").select(
            "doc_id", F.concat(F.lit("http://d/"), F.col("doc_id")).alias("url"),
            F.substring_index("text", " ", 3).alias("title"), F.col("text").alias("content"),
        )
        new = base.filter(F.col("doc_id") % 2 == 0).select(
            (F.col("doc_id") + 1000000000).alias("doc_id"), "url",
            F.concat(F.lit("new "), F.col("title")).alias("title"),
            F.concat(F.lit("v2 "), F.col("content")).alias("content"),
        )
        return base.filter(F.col("doc_id") % 3 != 0), new

    def clean_documents(self) -> DataFrame:
        """(doc_id, content) in the cleaned form that is indexed.

        The generator stands for the stored column: filters on the content stay above it and do not clean again.
        """
        text = F.explode(F.array(clean_text("text")))
        return self.spread("documents", "doc_id").select("doc_id", text.alias("content"))
