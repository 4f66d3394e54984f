"""SimHash near-duplicates by an inverted index over byte positions with count filtering (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .graph import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
_ONES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles, as an unsigned number; no words give 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only the six white-space bytes part words
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    spans = zip(starts.tolist(), ends[shingle - 1 :].tolist() or [len(joined)], strict=False)
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
    votes = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65_536):
        rows = hashes[part : part + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed 64-bit column ``name``."""
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, whole.schema.names[at]):
                found = np.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], np.uint64)
                columns = [*batch.columns, pa.array(found.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    from pyspark.sql.types import LongType, StructType

    return docs.mapInArrow(add, StructType([*docs.schema.fields]).add(name, LongType()))


def index_positions(matches: int) -> list[tuple[int, ...]]:
    """Triples of the 8 byte positions such that any ``matches`` positions hold at least one of them.

    For four matches or more these are Turan's 20 triples over the groups 0-2, 3-5 and 6-7: inside one group, or two
    of one group and one of the next. For three matches every triple is needed.
    """
    if matches < 3:
        raise ValueError("at most 5 differing bits can be searched with triples of byte positions")
    triples = list(combinations(range(8), 3))
    if matches == 3:
        return triples
    shape = {(0, 0, 0), (1, 1, 1), (0, 0, 1), (1, 1, 2), (0, 2, 2)}
    return [t for t in triples if tuple(p // 3 for p in t) in shape]


def near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Matrix of pairs that share enough positional bytes (the count filter) and differ in few enough bits (the check)."""
    diff = x[:, None] ^ y[None, :]
    spread = diff | (diff >> np.uint64(4))
    spread |= spread >> np.uint64(2)
    spread |= spread >> np.uint64(1)
    shared = 8 - np.bitwise_count(spread & _ONES)
    return (shared >= 8 - max_bits) & (np.bitwise_count(diff) <= max_bits)


def _links(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (value, smallest value of its group) among the fingerprints of one posting list.

    A breadth-first walk takes reached fingerprints out of the rest, so dense groups cost little more than one pass.
    """
    rest = np.unique(values)  # as signed numbers, so that the smallest is the smallest in Spark too
    out_a, out_b = [], []
    while len(rest) > 1:
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            reached = np.zeros(len(rest), bool)
            step = max(1, 1_000_000 // len(rest))
            for k in range(0, len(front), step):
                block = near(front[k : k + step].view(np.uint64), rest.view(np.uint64), max_bits)
                reached |= block.any(axis=0)
            front, rest = rest[reached], rest[~reached]
            out_a.append(front)
            out_b.append(np.full(len(front), root))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, list_limit: int = 16_384) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column ``fp``, distinct) linked at ``max_bits`` or fewer bits.

    Postings are keyed by triples of positional bytes: fingerprints within the distance agree in at least 8 - max_bits
    bytes and so meet under one triple or more. Pairs in a list are tallied over all eight bytes, must reach that
    guaranteed number and are then verified; a list gives at most one edge per member. Lists above ``list_limit``
    distinct fingerprints are searched another exact way (``_midpoint_links``).
    """
    def byte(p: int):
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)

    keys = [
        (F.lit(k << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c)).alias("k")
        for k, (a, b, c) in enumerate(index_positions(8 - max_bits))
    ]
    postings = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(postings.join(sizes, "key"), "postings")
    lists = shared.filter(F.col("n") <= list_limit).groupBy("key").agg(F.collect_list("fp").alias("fps")).select("fps")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                a, b = _links(np.asarray(row.values), max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    found = lists.mapInArrow(search, "a bigint, b bigint")
    hot = shared.filter(F.col("n") > list_limit).select("fp").distinct()
    return found.union(_midpoint_links(hot, max_bits))


def _midpoint_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Edges for fingerprints of very long posting lists, with no pair compared.

    Two fingerprints within 2r bits have a common value within r bits of both. Every fingerprint is sent to all values
    within r bits; members of one value are within 2r bits of each other, so linking them to the smallest is exact,
    and a value never has more members than its own ball. For an odd distance one side takes one bit more.
    """
    near_r, far_r = max_bits // 2, max_bits - max_bits // 2

    def masks(radius: int) -> np.ndarray:
        bits = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(64), r)]
        return np.array(bits, np.uint64).view(np.int64)

    def ball(radius: int):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flips = masks(radius)
            for batch in batches:
                values = np.asarray(batch.column(0))
                for k in range(0, len(values), 64):
                    part = values[k : k + 64]
                    sent = (part[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sent), pa.array(np.repeat(part, len(flips)))], ["mid", "fp"]
                    )

        return prints.mapInArrow(send, "mid bigint, fp bigint")

    inner = ball(near_r)
    low = inner.groupBy("mid").agg(F.min("fp").alias("b"))
    edges = inner.join(low, "mid").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    if far_r > near_r:  # distance 2r + 1: members of the outer ball link to the members of the inner one
        cross = ball(far_r).join(inner.withColumnRenamed("fp", "b"), "mid").filter("fp <> b")
        edges = edges.union(cross.select(F.col("fp").alias("a"), "b").distinct())
    return edges.distinct()


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, list_limit: int = 16_384, text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Fingerprints at ``max_bits`` or fewer differing bits are linked; ``component_id`` is the smallest doc_id that can be
    reached. Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows come out
    once each; a null doc_id counts for no component, so a component without any id has none. Other columns are not
    read. An empty table gives an empty result. Equal fingerprints travel as one row with their smallest id.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"))
    prints = stored(with_fingerprint(rows, "fp", shingle).select("doc_id", "fp"), "fingerprints")
    labels = _labels(prints, max_bits, list_limit)
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labels(prints: DataFrame, max_bits: int, list_limit: int) -> DataFrame:
    """(fp, component_id, root): one row per distinct fingerprint."""
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(fingerprint_links(firsts.select("fp"), max_bits, list_limit), "simhash")
    joined = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(least, "root").select("fp", "component_id", "root", "first_id")


def keep_one_each(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, list_limit: int = 16_384, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component: its smallest doc_id.

    Repeated rows of that document become one. Where no document of a component has an id, one row of its smallest
    fingerprint stays.
    """
    name = "_fp_" + "_".join(docs.columns)  # longer than any column of the input, so no clash
    marked = with_fingerprint(docs.withColumn(text, F.col(text).cast("string")), name, shingle)
    prints = stored(marked.select("doc_id", F.col(name).alias("fp")), "fingerprints")
    labels = _labels(prints, max_bits, list_limit)
    # The first fingerprint of a component that holds its smallest id.
    own = labels.filter(F.col("first_id").eqNullSafe(F.col("component_id")))
    chosen = own.groupBy("root").agg(F.min(F.struct("fp", "component_id")).alias("s")).select("s.*")
    same = (marked[name] == chosen["fp"]) & marked["doc_id"].eqNullSafe(chosen["component_id"])
    return marked.join(chosen, same, "left_semi").dropDuplicates([name]).drop(name)
