"""Odd rows: nulls, empty and long texts, ties, repeated rows, empty tables, and extra columns with clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from trawlspark.llm import decontaminate, html, licenses, lines, mixing, passages, quality, simhash, tokens, toxicity

CLASHING = "size score fp key pos row_key target taken draws n h doc block kept lines a b part seed n_words first_id text_key path2".split()
LONG = "word and another line of the text here\n" * 3000
ROWS = [
    (None, None, None), (None, "no id but a text of some words", "s"), (1, "", "s"), (1, "", "s"), (2, None, "t"),
    (3, "the same line is here twice\nshort\nthe same line is here twice", None),
    (4, "the same line is here twice\nOther line that is unique", "s"),
    (4, "the same line is here twice\nOther line that is unique", "s"), (5, LONG, "t"), (6, " \n\t ", "t"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(c) for c in CLASHING}).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, None), (2, 1, 1), (None, 1, 1), (3, 0, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "x"), (None, "a" * 60)], "item_id long, text string")


def digests(docs, labels, bench):
    with_path = docs.withColumn("path", F.concat(F.lit("/a/"), F.col("doc_id")))
    return {
        "mix": mixing.mix_sources(docs),
        "simhash": simhash.simhash_components(docs),
        "quality": quality.quality_rules(docs),
        "tokens": tokens.count_tokens(docs),
        "toxicity": toxicity.score_documents(docs, labels),
        "lines": lines.line_digests(docs),
        "licenses": licenses.scan_licenses(with_path),
    }


def filters(docs, labels, bench):
    return {
        "toxic": toxicity.drop_toxic(docs, labels),
        "lines": lines.drop_repeated_lines(docs),
        "bench": decontaminate.drop_contaminated(docs, bench),
        "simhash": simhash.keep_one_each(docs),
    }


def test_every_row_comes_out_once(docs, labels, bench):
    want = sorted((r[0] is None, r[0] or 0) for r in ROWS)
    for name, df in digests(docs, labels, bench).items():
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())
        assert got == want, name


def test_filters_keep_the_columns(docs, labels, bench):
    for name, df in filters(docs, labels, bench).items():
        assert df.columns == docs.columns and [f.dataType for f in df.schema] == [f.dataType for f in docs.schema], name
        assert df.count() == (len(ROWS) if name in ("toxic", "lines", "bench") else 5), name


def test_empty_tables(spark, docs, labels, bench):
    none, no_labels, no_bench = docs.limit(0), labels.limit(0), bench.limit(0)
    for name, df in {**digests(none, labels, bench), **filters(none, labels, bench)}.items():
        assert df.count() == 0, name
    assert toxicity.score_documents(docs, no_labels).filter("score = 0.5").count() == len(ROWS)
    assert decontaminate.find_passages(docs, no_bench).count() == 0
    assert passages.shared_passages(none).count() == 0
    assert html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_defined_results(docs, bench):
    by_id = lambda df: {r["doc_id"]: r for r in df.filter("doc_id is not null").collect()}
    counted = by_id(tokens.count_tokens(docs))
    assert (counted[1]["n_bytes"], counted[1]["n_tokens"], counted[2]["n_tokens"]) == (0, 0, 0) and counted[5]["over_limit"]
    prints = by_id(simhash.simhash_components(docs))
    assert prints[1]["fingerprint"] == prints[6]["fingerprint"] == "0" * 16 and prints[6]["component_id"] == 1
    cut = by_id(lines.line_digests(docs))
    assert (cut[4]["n_lines"], cut[4]["n_dropped"], cut[3]["n_dropped"]) == (2, 1, 0)
    assert cut[4]["kept_sha256"] == hashlib.sha256(b"Other line that is unique").hexdigest()
    assert (cut[1]["n_lines"], cut[2]["kept_sha256"]) == (1, hashlib.sha256(b"").hexdigest())
    rules = by_id(quality.quality_rules(docs))
    assert rules[3]["n_dup_lines"] == 1 and not rules[1]["kept"] and rules[5]["n_repeat_words"] == rules[5]["n_words"] == 24000
    mixed = by_id(mixing.mix_sources(docs))
    assert mixed[1]["size"] == 0 and mixed[1]["taken"] == 0 and all(r["taken"] <= 3 * r["size"] for r in mixed.values())
    assert decontaminate.find_passages(docs, bench).count() == 0
    assert passages.shared_passages(docs).count() == 0


def test_pages(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "v", "<p>" + "x " * 200_000), (3, "w", "<a href='")]
    got = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 399_999), (3, 0)]
