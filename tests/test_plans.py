"""The physical plans the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from trawlspark.operators import documents, frontier, robots, search
from trawlspark.operators.chunks import chunk_spans
from trawlspark.plans.catalog import queries
from trawlspark.plans.fixtures import Inputs, as_of
from trawlspark.session import fresh_dir

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture
def inputs(spark):
    return Inputs(spark, SF)


def test_no_plan_has_a_cross_join(spark):
    for name, q in queries().items():
        if not name.startswith(("stream_", "table_")):
            text = plan(q(spark, SF))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_best_chunk_is_cut_before_the_shuffle(inputs):
    text = plan(search.best_chunk_per_doc(search.best_candidates(inputs.chunks(), inputs.query_vectors(1))))
    assert text.count("WindowGroupLimit") >= 2


def test_dequeue_is_cut_before_the_shuffle(inputs):
    text = plan(frontier.dequeue(inputs.frontier(), inputs.sites())[0])
    assert text.count("WindowGroupLimit") >= 2


def test_single_page_is_a_bounded_sort(inputs):
    best = inputs.chunks().select("chunk_id", F.col("chunk_start").cast("double").alias("similarity"))
    assert "TakeOrderedAndProject" in plan(search.rank_page(best, 10, 10))


def test_robots_join_is_an_equi_join(inputs):
    text = plan(robots.robots_allowed(inputs.frontier(), robots.parse_robots(inputs.robots())))
    assert re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) LeftOuter", text) and "NestedLoop" not in text


def test_robots_parse_needs_no_shuffle(spark):
    texts = spark.createDataFrame([("h", 200, "User-agent: *")], "host string, status int, body string")
    assert "Exchange" not in plan(robots.parse_robots(texts))


def test_chunk_spans_are_native_and_local(inputs):
    text = plan(chunk_spans(inputs.table("documents").select("doc_id", "text"), "text", with_input=True))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_not_in_never_broadcasts_the_chunk_table(spark, inputs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(documents.missing_documents(inputs.documents(), inputs.chunks(null_docs=True)))
        assert "SortMergeJoin LeftAnti" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_are_pruned_and_filters_pushed(spark, inputs):
    text = plan(frontier.not_visited(inputs.frontier(), inputs.visited(), as_of()))
    assert "html" not in text
    home = fresh_dir(spark, "docs")
    inputs.documents().write.parquet(home)
    page = spark.createDataFrame([(3, 0.5), (7, 0.4)], "doc_id long, similarity double")
    text = plan(search.attach_documents(page, spark.read.parquet(home), lookup=True))
    assert re.search(r"PushedFilters: \[.*In\(doc_id, \[3,7\]\)", text)
    text = plan(search.best_candidates(inputs.chunks(), inputs.query_vectors(1), 5))
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text


def test_hot_host_is_split_in_the_join(spark):
    """A host with a third of all rows: adaptive execution splits its partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        host = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 5000))
        urls = spark.range(0, 300000, 1, 8).select("id", host.alias("host"), F.sha2(F.col("id").cast("string"), 256).alias("p"))
        urls = urls.select("host", F.concat(F.lit("http://"), "host", F.lit("/"), "p").alias("url"))
        texts = spark.range(5000).select(
            F.concat(F.lit("h"), "id").alias("host"), F.lit(200).alias("status"),
            F.lit(f"User-agent: {robots.DEFAULT_AGENT}\nDisallow: /0").alias("body"))
        got = robots.robots_allowed(urls, robots.parse_robots(texts))
        assert got.filter("not allowed").count() > 0
        got.write.format("noop").mode("overwrite").save()
        done = got.agg(F.count("url"), F.count_if("allowed"))
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_python_calls_are_not_repeated(inputs, spark):
    from trawlspark.operators import chunks, pages

    ok, _ = pages.split_empty(inputs.parsed_pages())
    links = inputs.links().filter("host is not null and pos > 0")
    windows = chunks.chunk_windows(chunks.tokenize(inputs.clean_documents(), "content").drop("content"))
    for df in (pages.page_content(ok), links, windows):
        assert len(re.findall(r"\n\(\d+\) ArrowEvalPython", plan(df))) == 1


def test_cleaning_and_json_run_once_per_row(inputs):
    from trawlspark.operators.chunks import check_length
    from trawlspark.sources.messages import read_messages, to_messages

    ok, _ = check_length(inputs.clean_documents(), "content")
    assert plan(ok).count("[^\\n\\]]*+") <= 3  # output, input and argument lines of one projection
    rows = inputs.table("pages").selectExpr("url", "1 as depth", "html as content")
    text = plan(read_messages(to_messages(rows, F.lit(0).cast("timestamp")).drop("id"))[0])
    assert "Filter" not in text.split("Generate")[0] or "from_json" not in re.findall(r"Condition.*", text)[-1]
