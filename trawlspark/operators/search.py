"""Exact vector search: score chunks, best chunk per document, result pages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .ranking import first_per_group

# Query vectors a task reads at a time, and keeps for all its chunks where they are all there is.
QUERY_BLOCK_BYTES = 16 * 1024 * 1024
# Chunk vectors that meet one reading of the queries, where a task does not keep these.
CHUNK_BLOCK_BYTES = 64 * 1024 * 1024
# Candidates a task holds before it hands them on, and cells of one similarity matrix.
HELD_BYTES = 64 * 1024 * 1024
MATRIX_CELLS = 4_000_000


def _best_first():
    return [F.col("similarity").desc(), F.col("chunk_id").asc()]


def check_page(limit: int, offset: int) -> None:
    for name, value in (("limit", limit), ("offset", offset)):
        if not 0 <= value < 2**31:
            raise ValueError(f"{name} must be between 0 and 2147483647")


class QueryBlocks:
    """The written queries of a search as unit vectors, read block by block by each task.

    ``files`` are Parquet files in the shared folder, opened through pyarrow's file systems (local paths, HDFS and the
    usual object stores). Blocks are numbered in the order of the files. What fits one block is read once per task.
    """

    def __init__(self, files: list[str], depth: int | None, block_bytes: int):
        self.files, self.depth, self.block_bytes = files, depth, block_bytes
        self._kept: list[tuple[pa.Array, np.ndarray, np.ndarray | None]] | None = None
        self._rows: int | None = None

    def _open(self, file: str) -> pq.ParquetFile:
        system, path = fs.FileSystem.from_uri(file)
        return pq.ParquetFile(system.open_input_file(path))

    def fit(self, dims: int) -> bool:
        if self._rows is None:
            self._rows = sum(self._open(f).metadata.num_rows for f in self.files)
        return self._rows * dims * 8 <= self.block_bytes

    def __call__(self, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray | None]]:
        """(query ids, unit vectors, depths) block by block; rows without vector are left out."""
        if self._kept is not None:
            yield from self._kept
            return
        found = self._read(dims)
        if self.fit(dims):
            self._kept = list(found)
            found = iter(self._kept)
        yield from found

    def _read(self, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray | None]]:
        for file in self.files:
            source = self._open(file)
            own = [c for c in ("depth", "limit", "offset") if c in source.schema_arrow.names]
            for batch in source.iter_batches(max(1, self.block_bytes // (dims * 8)), columns=["query_id", "vector", *own]):
                batch = batch.filter(batch.column("vector").is_valid())
                if not batch.num_rows:
                    continue
                depth = None
                if self.depth is not None:
                    depth = np.full(batch.num_rows, self.depth, np.int64)
                elif "depth" in own:
                    depth = np.asarray(batch.column("depth").cast(pa.int64()))
                elif {"limit", "offset"} <= set(own):
                    depth = sum(np.asarray(batch.column(c).cast(pa.int64())) for c in ("limit", "offset"))
                yield batch.column("query_id"), _unit_rows(batch.column("vector"), dims), None if depth is None else np.maximum(depth, 1)


def _unit_rows(column: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors of one Arrow column; NaN where a vector has no direction."""
    sizes = np.asarray(pc.list_value_length(column))
    if (sizes != dims).any():
        raise ValueError(f"vectors differ in length: expected {dims}, got {sorted(set(sizes.tolist()))}")
    matrix = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dims)
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _keep_best(table: pa.Table, depth: np.ndarray) -> pa.Table:
    """Per query number the best row of each document, and of these as many as its depth."""
    order = [("_q", "ascending"), ("similarity", "descending"), ("chunk_id", "ascending")]
    table = table.take(pc.sort_indices(table, sort_keys=order))
    q = np.asarray(table.column("_q"))
    doc = np.asarray(table.column("doc_id").combine_chunks().dictionary_encode().indices).astype(np.int64)
    first = np.sort(np.unique(q * (doc.max(initial=0) + 1) + doc, return_index=True)[1])
    ranked = q[first]
    rank = np.arange(len(first)) - np.searchsorted(ranked, ranked, side="left")
    return table.take(pa.array(first[rank < depth[ranked]]))


class _Chunks:
    """Some chunks, sorted by document and id, with unit vectors."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("chunk_id", "ascending")]))
        vectors = table.column("embedding").combine_chunks()
        self.unit = _unit_rows(vectors, len(vectors[0]))
        self.plain = table.drop_columns(["embedding"])
        doc = np.asarray(table.column("doc_id").combine_chunks().dictionary_encode().indices)
        self.start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        self.doc = np.cumsum(np.r_[False, doc[1:] != doc[:-1]])

    def hits(self, unit: np.ndarray, depth: np.ndarray | None, floor: np.ndarray) -> pa.Table | None:
        """Best chunk per query and document that reaches the query's floor; floors rise to the last place a query has here."""
        found = []
        step = max(1, MATRIX_CELLS // len(self.unit))
        for at in range(0, len(unit), step):
            sims = self.unit @ unit[at : at + step].T
            sims[np.isnan(sims)] = -np.inf  # a vector without direction is no hit
            best = np.maximum.reduceat(sims, self.start, axis=0)
            low = floor[at : at + step]
            if depth is not None:
                own = depth[at : at + step]
                for d in np.unique(own[own <= len(best)]).tolist():
                    of = np.flatnonzero(own == d)
                    low[of] = np.maximum(low[of], np.partition(best[:, of], len(best) - d, axis=0)[len(best) - d])
            hit = (best >= low) & (best > -np.inf)
            if len(self.start) < len(sims):
                hit = hit[self.doc] & (sims == best[self.doc])
            rows, qs = np.nonzero(hit)
            if len(rows):
                first = np.unique(self.doc[rows] * sims.shape[1] + qs, return_index=True)[1]
                rows, qs = rows[first], qs[first]
                found.append((rows, qs + at, sims[rows, qs]))
        if not found:
            return None
        rows, qs, similarity = (np.concatenate(c) for c in zip(*found, strict=True))
        table = self.plain.take(pa.array(rows))
        return table.append_column("_q", pa.array(qs.astype(np.int64))).append_column("similarity", pa.array(similarity))


def best_candidates(
    chunks: DataFrame, query_vectors: DataFrame, k: int | None = None, block_bytes: int = QUERY_BLOCK_BYTES, written: bool = False
) -> DataFrame:
    """Scored chunks (query_id, chunk columns, similarity) reduced inside each task, ahead of any shuffle.

    A block join: the queries are written once to the shared folder, the chunks are read once, and each task reads the
    queries in blocks for every ``CHUNK_BLOCK_BYTES`` of its chunks (once, where one block holds them all). No vector
    passes the driver and none is broadcast, however many queries there are; a task holds two blocks, its candidates up
    to ``HELD_BYTES``, and 8 bytes a query. ``written`` says that ``query_vectors`` is a plain read of such files.

    Every task keeps the best chunk per query and document it sees and, given ``k`` or a column ``depth`` (or ``limit``
    and ``offset``) per query, only so many documents per query. That loses no result: a document among the overall best
    ``k`` is among the best ``k`` of the task that holds its best chunk. A document with very many chunks, or a hot query,
    leaves a task as few rows. Chunks without vector or document are no hits.
    """
    usable = chunks.filter(F.col("embedding").isNotNull() & F.col("doc_id").isNotNull())
    asked = query_vectors
    if not written:
        asked = stored(query_vectors.select(*(c for c in query_vectors.columns if c in ("query_id", "vector", "depth", "limit", "offset"))), "queries")
    queries = QueryBlocks(sorted(asked.inputFiles()), k, block_bytes)
    payload = [f for f in chunks.schema.fields if f.name != "embedding"]
    schema = T.StructType([asked.schema["query_id"], *payload, T.StructField("similarity", T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[pa.Array, pa.Table]] = {}
        floors: dict[int, np.ndarray] = {}

        def handed_on(tables: list[tuple[pa.Array, pa.Table]]) -> Iterator[pa.RecordBatch]:
            for ids, table in tables:
                out = table.append_column("query_id", ids.take(table.column("_q").combine_chunks())).select(names)
                yield from out.to_batches()

        for some in _chunk_blocks(batches, queries):
            block = _Chunks(some)
            for number, (ids, unit, depth) in enumerate(queries(block.unit.shape[1])):
                floor = floors.setdefault(number, np.full(len(ids), -np.inf))
                table = block.hits(unit, depth, floor)
                if table is None:
                    continue
                if depth is None:
                    yield from handed_on([(ids, table)])
                    continue
                merged = _keep_best(pa.concat_tables([held[number][1], table]) if number in held else table, depth)
                held[number] = ids, merged
                q, s = np.asarray(merged.column("_q")), np.asarray(merged.column("similarity"))
                full = np.bincount(q, minlength=len(ids)) >= depth
                ends = np.searchsorted(q, np.arange(len(ids)), side="right")
                floor[full] = np.maximum(floor[full], s[ends[full] - 1])
                if sum(t.nbytes for _, t in held.values()) > HELD_BYTES:
                    # What follows must still reach the floors; the ranking merges the parts.
                    yield from handed_on(list(held.values()))
                    held.clear()
        yield from handed_on(list(held.values()))

    return usable.mapInArrow(run, schema)


def _chunk_blocks(batches: Iterator[pa.RecordBatch], queries: QueryBlocks) -> Iterator[list[pa.RecordBatch]]:
    """Batch by batch where the task keeps the queries, else as many as make ``CHUNK_BLOCK_BYTES``."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            if queries.fit(len(batch.column("embedding")[0])) or sum(b.nbytes for b in some) >= CHUNK_BLOCK_BYTES:
                yield some
                some = []
    if some:
        yield some


def best_chunk_per_doc(scored: DataFrame) -> DataFrame:
    """Highest similarity per query and document, lowest chunk_id on ties."""
    return first_per_group(scored, ["query_id", "doc_id"], _best_first())


def rank_page(best: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One page of a single query, best first."""
    check_page(limit, offset)
    return best.orderBy(*_best_first()).offset(offset).limit(limit)


def rank_pages(best: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One page per query, with the rank; the rank filter cuts each query's rows ahead of the shuffle."""
    check_page(limit, offset)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*_best_first()))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= offset + limit)
    return ranked.filter(F.col("rank") > offset)


def attach_documents(ranked: DataFrame, documents: DataFrame, lookup: bool = False) -> DataFrame:
    """Adds url, content and title. Comes after the limit, so that only the page's documents are read in full.

    A plain join, for result pages of any size. With ``lookup`` the ids of the page are fetched and pushed into the
    document scan, where row-group statistics skip almost everything: the way for one page shown to a person.
    """
    wanted = documents.select("doc_id", "url", "content", "title")
    if lookup:
        rows = ranked.collect()
        page = ranked.sparkSession.createDataFrame(rows, ranked.schema)
        ids = sorted({r["doc_id"] for r in rows})
        return page.join(wanted.filter(F.col("doc_id").isin(ids) if ids else F.lit(False)), "doc_id")
    return ranked.join(wanted, "doc_id")


def known_chunks(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks whose document exists.

    Orphaned ids are found on the id columns alone and stored, so the vectors need no shuffle while orphans are few.
    """
    ids = chunks.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    orphans = stored(ids.join(documents.select("doc_id"), "doc_id", "left_anti"), "orphans")
    return chunks.join(orphans, "doc_id", "left_anti")


def top_documents(
    chunks: DataFrame,
    documents: DataFrame,
    query_vectors: DataFrame,
    limit: int = 10,
    offset: int = 0,
    assume_fk: bool = False,
    block_bytes: int = QUERY_BLOCK_BYTES,
    written: bool = False,
) -> DataFrame:
    """The page of each query: (query_id, rank, chunk columns, similarity), document text not attached yet.

    Columns limit and offset of the queries, if present, replace the two arguments. ``assume_fk`` states that every
    chunk's document exists, as the table writers of this package ensure; else chunks of missing documents are taken
    out first, because they would take places of real hits. Tasks keep limit + offset documents per query. See
    ``best_candidates`` for ``block_bytes`` and ``written``.
    """
    check_page(limit, offset)
    own = {"limit", "offset"} <= set(query_vectors.columns)
    usable = chunks if assume_fk else known_chunks(chunks, documents)
    best = best_chunk_per_doc(best_candidates(usable, query_vectors, None if own else limit + offset, block_bytes, written))
    if not own:
        return rank_pages(best, limit, offset)
    pages = query_vectors.select("query_id", F.col("limit").alias("_l"), F.col("offset").alias("_o"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*_best_first()))
    ranked = best.withColumn("rank", rank).join(pages, "query_id")
    return ranked.filter((F.col("rank") > F.col("_o")) & (F.col("rank") <= F.col("_o") + F.col("_l"))).drop("_l", "_o")
