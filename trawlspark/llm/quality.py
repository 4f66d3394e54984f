"""Quality rules with cross-document line frequency (operator 4); DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, stored
from .lines import line_keys, split_lines

WINDOW = 8
_END = 2**30  # more than any number of words
_NO_ID = -(2**63)


def _window_hashes(words: Column) -> Column:
    """Hashes of all runs of 8 words: pairs, pairs of pairs, and so on, each from the step before."""

    def paired(distance: int):
        return lambda h: F.zip_with(h, F.slice(h, F.lit(distance + 1), F.lit(_END)), lambda a, b: F.xxhash64(a, b))

    step = F.transform(words, lambda w: F.xxhash64(w))
    for distance in (1, 2, 4):
        step = let(step, paired(distance))
    return F.slice(step, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def repeat_words(words: Column) -> Column:
    """Number of words that lie in an 8-word window found twice or more in the text, the first find included.

    Texts whose windows all differ, the great majority, stop at one hash set; the others sort (hash, place) pairs.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            pairs,
            lambda s: F.filter(
                s,
                lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
            ),
        )
        places = F.sort_array(F.transform(twice, lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        total = F.aggregate(
            places,
            start,
            lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"), (p + WINDOW).alias("end")),
            lambda a: a["n"],
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(total)

    return let(_window_hashes(words), covered).cast("bigint")


def base_metrics(text: Column) -> dict[str, Column]:
    """The counts of one text; null is empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), 0)
    lines = F.filter(split_lines(text), lambda x: F.regexp_like(x, F.lit(WORD)))
    return {
        "n_words": F.regexp_count(whole, F.lit(WORD)).cast("bigint"),
        "word_chars": F.char_length(F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")).cast("bigint"),
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": let(words, repeat_words),
    }


def _row_key(docs: DataFrame, host: str, text: str) -> Column:
    """128 bits that tell rows apart by id, text and host, nulls included; equal rows are decided alike."""
    parts = [docs["doc_id"].cast("bigint"), docs[host].cast("string"), docs[text].cast("string")]
    parts += [c.isNull() for c in parts]
    return F.struct(F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts))


def quality_rules(
    docs: DataFrame,
    min_words: int = 20,
    repeat_percent: int = 30,
    min_line_docs: int = 20,
    line_share: float = 0.01,
    min_left: float = 0.25,
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_left_words).

    A line (A-Z lowered, stripped, with a word) that more than ``min_line_docs`` distinct documents of its host and
    more than ``line_share`` of them hold is boilerplate there. A document is kept if it passes the base rules and at
    least ``min_left`` of its words stand in other lines (``n_left_words``).

    Null and empty texts have no words and fail the base rules. Documents with a null host form one host; all rows with
    a null id count as one document of it. Repeated rows are decided alike and come out once each. Other columns are
    not read. An empty table gives an empty result. One row per document and distinct line is counted, combined before
    each shuffle, so neither a hot host nor a hot line meets in one task.
    """
    metrics = base_metrics(docs[text])
    lines = F.filter(
        F.transform(
            line_keys(docs[text]),
            lambda k: F.struct(F.xxhash64(k).alias("h"), F.regexp_count(k, F.lit(WORD)).alias("n")),
        ),
        lambda x: x["n"] > 0,
    )
    base = stored(
        docs.select(
            docs["doc_id"].cast("bigint").alias("doc_id"),
            docs[host].cast("string").alias("host"),
            _row_key(docs, host, text).alias("row_key"),
            *[c.alias(n) for n, c in metrics.items()],
            lines.alias("lines"),
        ),
        "quality",
    )
    doc = F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc")
    held = base.select("host", doc, F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    common = held.groupBy("host", "h").agg(F.count_distinct("doc").alias("n_docs")).filter(F.col("n_docs") > min_line_docs)
    hosts = base.select("host", doc).groupBy("host").agg(F.count_distinct("doc").alias("of_docs"))
    same_host = common["host"].eqNullSafe(hosts["host"])
    over = common.join(hosts, same_host).filter(F.col("n_docs") > line_share * F.col("of_docs"))
    limits = stored(over.select(common["host"].alias("over_host"), F.col("h").alias("over_h")), "boilerplate")

    each = base.select("row_key", "host", F.posexplode("lines").alias("pos", "line"))
    hit = each.join(limits, (F.col("line.h") == F.col("over_h")) & F.col("host").eqNullSafe(F.col("over_host")))
    removed = hit.groupBy("row_key").agg(F.collect_set(F.struct("pos", "line.n")).alias("cut"))
    cut_words = F.aggregate("cut", F.lit(0), lambda a, x: a + x["n"])
    checked = base.drop("lines", "host").join(removed.select("row_key", cut_words.alias("cut")), "row_key", "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    left = (F.col("n_words") - F.coalesce("cut", F.lit(0))).cast("bigint")
    return checked.select(
        "doc_id",
        *metrics,
        failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("n_words"))).alias("kept"),
        left.alias("n_left_words"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, range(0, 8) x(k) GROUP BY rid),
l AS (SELECT rid, doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d),
k AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
u AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM k GROUP BY rid),
h AS (SELECT source, count(DISTINCT coalesce(doc_id, -9223372036854775808)) AS of_docs FROM d GROUP BY source),
f AS (SELECT source, key, count(DISTINCT coalesce(doc_id, -9223372036854775808)) AS n_docs FROM k GROUP BY source, key),
o AS (SELECT f.source, key FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source WHERE n_docs > 20 AND n_docs > 0.01::DOUBLE * of_docs),
x AS (SELECT rid, sum(n)::BIGINT AS cut FROM k JOIN o ON k.key = o.key AND k.source IS NOT DISTINCT FROM o.source GROUP BY rid),
a AS (SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(u.n, 0)::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(cut, 0) AS cut
      FROM d JOIN w USING (rid) LEFT JOIN u USING (rid) LEFT JOIN c USING (rid) LEFT JOIN x USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - cut >= 0.25::DOUBLE * n_words AS kept, n_words - cut AS n_left_words FROM b
"""
