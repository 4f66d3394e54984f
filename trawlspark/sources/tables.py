"""The three catalog tables: create, read, append, replace, drop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import delete_documents, orphan_chunks, upsert_documents
from ..operators.embed import check_chunks
from ..operators.frontier import enqueue_links
from ..schemas import CHUNKS, DOCUMENTS, FRONTIER
from ..session import stored

TABLES = {"frontier": FRONTIER, "documents": DOCUMENTS, "chunks": CHUNKS}
_BUCKET_KEY = {"frontier": "host", "documents": "doc_id", "chunks": "doc_id"}
# Keyed tables are partitioned by a hash of the key of their writes, so that a write rewrites its own parts alone.
_PART_KEY = {"documents": "url", "chunks": "doc_id"}


def create_tables(spark: SparkSession, db: str, location: str | None = None, buckets: int = 0, parts: int = 64) -> "Tables":
    """Creates what is missing. With ``buckets`` the tables are bucketed by the key their joins use.

    ``parts`` is the number of hash partitions of documents and chunks; a handle must use the number of its tables.
    """
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{at}")
    for name, schema in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        layout = f" CLUSTERED BY ({_BUCKET_KEY[name]}) INTO {buckets} BUCKETS" if buckets else ""
        if name in _PART_KEY:
            columns += ", part int"
            layout = f" OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (part){layout}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({columns}) USING parquet{layout}")
    return Tables(spark, db, parts)


def drop_tables(spark: SparkSession, db: str) -> None:
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")


@dataclass(frozen=True)
class Tables:
    """Handle on the tables of one database."""

    spark: SparkSession
    db: str
    parts: int = 64

    def read(self, name: str, parts: list[int] | None = None) -> DataFrame:
        """A table, or the given parts of it; the scan then skips the others."""
        rows = self.spark.table(f"{self.db}.{name}")
        if parts is not None:
            rows = rows.filter(F.col("part").isin(parts) if parts else F.lit(False))
        return rows.drop("part")

    def part(self, name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(_PART_KEY[name]).cast("string")), F.lit(self.parts)).cast("int")

    def parts_of(self, name: str, rows: DataFrame) -> list[int]:
        """Parts that hold the keys of ``rows``: a number of at most ``parts``."""
        return sorted(r[0] for r in rows.select(self.part(name)).distinct().collect())

    @property
    def frontier(self) -> DataFrame:
        return self.read("frontier")

    @property
    def documents(self) -> DataFrame:
        return self.read("documents")

    @property
    def chunks(self) -> DataFrame:
        return self.read("chunks")

    def document(self, doc_id: str) -> DataFrame:
        """Content of one document; the equality reaches the Parquet scan."""
        return self.documents.filter(F.col("doc_id") == doc_id).select("content")

    def append(self, name: str, df: DataFrame) -> None:
        self._rows(name, df).write.mode("append").insertInto(f"{self.db}.{name}")

    def _rows(self, name: str, df: DataFrame) -> DataFrame:
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
        return rows.withColumn("part", self.part(name)) if name in _PART_KEY else rows

    def append_links(self, links: DataFrame, as_of: Column) -> None:
        """Adds links not queued yet. Ids are unique and grow from the highest one in use."""
        base = self.frontier.agg(F.coalesce(F.max("url_id") + 1, F.lit(0))).first()[0]
        fresh = enqueue_links(self.frontier, links, as_of)
        self.append("frontier", fresh.withColumn("url_id", F.monotonically_increasing_id() + F.lit(base)))

    def append_chunks(self, chunks: DataFrame, dims: int) -> None:
        """Bulk append: vectors are checked, and a chunk of an unknown document fails the write.

        The test compares ids; the vectors are written where they lie.
        """
        ids = chunks.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
        lost = ids.join(self.documents.select("doc_id"), "doc_id", "left_anti").first()
        if lost is not None:
            raise ValueError(f"no document {lost['doc_id']} for a chunk")
        self.append("chunks", check_chunks(chunks, dims))

    def rewrite(self, name: str, parts: list[int], df: DataFrame) -> None:
        """New state of the given parts of a table; the others are neither read nor written.

        The new files are complete before they take the place of the old ones, so ``df`` may read the parts. Rows are
        laid out by doc_id: a lookup of a page's ids then skips nearly all row groups.
        """
        rows = self._rows(name, df).repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
        rows = stored(rows, name)
        rows.write.mode("overwrite").insertInto(f"{self.db}.{name}")
        filled = {r[0] for r in rows.select("part").distinct().collect()}
        for part in parts:
            if part not in filled:
                self.spark.sql(f"ALTER TABLE {self.db}.{name} DROP IF EXISTS PARTITION (part = {part})")

    def upsert_documents(self, new: DataFrame, as_of: Column, conflict_content: str = "new") -> None:
        parts = self.parts_of("documents", new)
        table, _ = upsert_documents(self.read("documents", parts), new, as_of, conflict_content)
        self.rewrite("documents", parts, table)

    def delete_documents(self, ids: DataFrame) -> None:
        """Deletes documents (doc_id) and their chunks; the urls of the ids are looked up on two narrow columns."""
        gone = self.documents.select("doc_id", "url").join(ids.select("doc_id"), "doc_id", "left_semi")
        parts, chunk_parts = self.parts_of("documents", gone), self.parts_of("chunks", ids)
        documents, chunks = delete_documents(self.read("documents", parts), self.read("chunks", chunk_parts), ids)
        self.rewrite("chunks", chunk_parts, chunks)
        self.rewrite("documents", parts, documents)

    def orphans(self) -> DataFrame:
        return orphan_chunks(self.chunks, self.documents)
