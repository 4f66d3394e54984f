"""Removal of lines that an earlier document already has (operator 8); DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stored

BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST_ID = 2**63 - 1  # stands for a null id: such a document comes after all others


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_keys(text: Column) -> Column:
    """Normalised lines: A-Z in lower case, white space stripped at both ends."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.transform(F.split(lower, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))


def row_key(docs: DataFrame, text: str) -> Column:
    """Tells apart rows that share an id; equal rows share the key and are decided alike."""
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs[text].cast("string"))


def line_bitmaps(docs: DataFrame, min_chars: int = 10, hot_rows: int = 1000, text: str = "text") -> DataFrame:
    """(row_key, n_dropped, keep_runs) of every document that loses lines.

    A key of ``min_chars`` or more code points that two documents hold stays only in the one with the smallest id.
    ``keep_runs`` is the document's keep bitmap in run-length form: (first line, number of lines) of each kept run, the
    last with number -1, up to the end. A row per line, without its text, is range-partitioned on a 128-bit hash of the
    key and sorted by hash, document and position; the first row of a key gives the document that keeps it, passed on
    along the sorted rows. Keys with more than ``hot_rows`` rows and a 100,000th of all rows do not take that way: a
    count, combined before its shuffle, gives their first document, and their rows stay where they are.
    """
    hashed = F.transform(
        line_keys(docs[text]),
        lambda k: F.when(F.char_length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))),
    )
    doc = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_LAST_ID)).alias("doc")
    exploded = docs.select(row_key(docs, text).alias("row_key"), doc, F.posexplode(hashed).alias("pos", "h"))
    lines = stored(exploded.filter("h is not null").select("row_key", "doc", "pos", "h.h1", "h.h2"), "lines")

    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("hot_first"))
    least = max(hot_rows, lines.count() // 100_000)  # so there are 100,000 hot keys at most
    hot = stored(counts.filter(F.col("n") > least).select("h1", "h2", "hot_first"), "hot-lines")
    known = lines.join(hot, ["h1", "h2"], "left")
    dropped_hot = known.filter("doc > hot_first").select("row_key", "pos")

    order = ["h1", "h2", "doc", "pos"]
    laid = known.filter("hot_first is null").drop("hot_first").repartitionByRange("h1", "h2").sortWithinPartitions(*order)
    first = F.first("doc").over(Window.partitionBy("h1", "h2").orderBy("doc", "pos").rowsBetween(Window.unboundedPreceding, 0))
    dropped = laid.withColumn("first", first).filter("doc > first").select("row_key", "pos").union(dropped_hot)

    def runs(drops: Column) -> Column:
        cuts = F.concat(F.array(F.lit(-1)), drops)
        last = F.size(drops)
        return let(
            cuts,
            lambda c: F.filter(
                F.transform(
                    F.sequence(F.lit(0), last),
                    lambda i: F.struct(
                        (F.get(c, i) + 1).alias("first"),
                        F.when(i == last, -1).otherwise(F.get(c, i + 1) - F.get(c, i) - 1).alias("n"),
                    ),
                ),
                lambda r: r["n"] != 0,
            ),
        )

    gathered = dropped.groupBy("row_key").agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    return gathered.select("row_key", F.size("drops").alias("n_dropped"), runs(F.col("drops")).alias("keep_runs"))


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The kept lines joined by line feeds; the whole text without a bitmap."""
    lines = split_lines(text)
    taken = let(
        lines,
        lambda all_lines: F.flatten(
            F.transform(
                keep_runs,
                lambda r: F.slice(all_lines, r["first"] + 1, F.when(r["n"] < 0, F.size(all_lines)).otherwise(r["n"])),
            )
        ),
    )
    return F.when(keep_runs.isNull(), F.coalesce(text.cast("string"), F.lit(""))).otherwise(F.array_join(taken, "\n"))


def line_digests(docs: DataFrame, min_chars: int = 10, hot_rows: int = 1000, text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row; see ``line_bitmaps`` and ``drop_repeated_lines``."""
    key = "_row_key_" + "_".join(docs.columns)
    bitmaps = line_bitmaps(docs, min_chars, hot_rows, text).withColumnRenamed("row_key", key)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs[text].alias("text"), row_key(docs, text).alias(key))
    return rows.join(bitmaps, key, "left").select(
        "doc_id",
        F.size(split_lines(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("keep_runs")), 256).alias("kept_sha256"),
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, hot_rows: int = 1000, text: str = "text") -> DataFrame:
    """``docs``, all rows and columns, with ``text`` reduced to the kept lines.

    Null and empty texts are one empty line and come out empty. Lines with a short key always stay, and so do repeats
    inside the document that keeps a key. Repeated rows with one id are one document. A null id counts as one more
    document after all others. A document that loses every line stays, with an empty text.
    """
    names = docs.columns
    tag = "_row_key_" + "_".join(names)
    maps = line_bitmaps(docs, min_chars, hot_rows, text).select(F.col("row_key").alias(tag), F.col("keep_runs").alias(tag + "_runs"))
    marked = docs.withColumn(tag, row_key(docs, text)).join(maps, tag, "left")
    return marked.withColumn(text, kept_text(F.col(text), F.col(tag + "_runs"))).select(*names)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key,
        coalesce(doc_id, 9223372036854775807) AS doc FROM l),
f AS (SELECT key, min(doc) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.*, first IS NULL OR doc = first AS kept FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (kept), '')) AS kept_sha256
FROM j GROUP BY rid
"""
