import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trawlspark.functions import vectors
from trawlspark.operators import embed, search
from trawlspark.plans.index import index_documents, index_ids
from trawlspark.plans.search import search as run_search

CHUNK = "chunk_id long, doc_id long, chunk_start long, chunk_end long, embedding array<float>"


def make_chunks(spark, n=3000, dims=8, seed=1):
    """A third of all chunks belongs to document 0; many vectors are equal."""
    rng = np.random.default_rng(seed)
    v = rng.integers(-2, 3, size=(n, dims)).astype(float)
    v[(v == 0).all(axis=1)] = 1.0
    doc = [0 if i % 3 == 0 else 1 + i % 200 for i in range(n)]
    rows = [(i, doc[i], 0, 10, v[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, CHUNK).repartition(7), v, doc


def make_queries(spark, n=4, dims=8, seed=2):
    q = np.random.default_rng(seed).normal(size=(n, dims))
    return spark.createDataFrame([(f"q{i}", f"text {i}", x.tolist()) for i, x in enumerate(q)], "query_id string, query string, vector array<double>"), q


def brute(v, doc, q, known=None):
    best = {}
    for i, x in enumerate(v):
        if known is not None and doc[i] not in known:
            continue
        s = float(x @ q / np.sqrt((x @ x) * (q @ q)))
        if doc[i] not in best or (-round(s, 9), i) < best[doc[i]]:
            best[doc[i]] = (-round(s, 9), i)
    return [(i, d) for (_, i), d in sorted((b, d) for d, b in best.items())]


def docs(spark, ids):
    return spark.createDataFrame([(d, f"u{d}", "content", "t") for d in ids], "doc_id long, url string, content string, title string")


@pytest.mark.parametrize("fk", [True, False])
@pytest.mark.parametrize("block", [search.QUERY_BLOCK_BYTES, 200])
def test_pages_equal_brute_force(spark, fk, block):
    chunks, v, doc = make_chunks(spark)
    queries, q = make_queries(spark)
    table = docs(spark, range(201))
    got = search.top_documents(chunks, table, queries, 5, 3, fk, block).collect()
    for n in range(len(q)):
        want = brute(v, doc, q[n])
        page = sorted((r["rank"], r["chunk_id"], r["doc_id"]) for r in got if r["query_id"] == f"q{n}")
        scores = {i: float(v[i] @ q[n] / np.linalg.norm(v[i]) / np.linalg.norm(q[n])) for i in range(len(v))}
        assert [r for r, *_ in page] == [4, 5, 6, 7, 8]
        # Equal vectors have equal scores but for rounding, so scores are compared, and the ids' documents.
        assert np.allclose([scores[c] for _, c, _ in page], [scores[i] for i, _ in want[3:8]])
        assert all(doc[c] == d for _, c, d in page)


@pytest.mark.parametrize("hot", [False, True])
def test_ten_blocks_of_queries_and_one_scan(spark, monkeypatch, hot):
    """Many query blocks, several chunk blocks a task, candidates handed on early: nothing lost, one scan of the chunks."""
    monkeypatch.setattr(search, "HELD_BYTES", 2000)
    monkeypatch.setattr(search, "MATRIX_CELLS", 500)
    monkeypatch.setattr(search, "CHUNK_BLOCK_BYTES", 3000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        chunks, v, doc = make_chunks(spark, 900)
        if hot:
            chunks, doc = chunks.withColumn("doc_id", F.lit(7).cast("long")), [7] * len(v)
        home = search.stored(chunks, "chunks")
        queries, q = make_queries(spark, 70)
        block = 7 * 8 * 8  # seven queries
        found = search.top_documents(home, docs(spark, range(201)), queries, 3, 1, True, block)
        text = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert text.count("FileScan") == 1 and "Broadcast" not in text and "CartesianProduct" not in text
        got = found.collect()
        files = search.stored(queries, "queries").inputFiles()
        assert len(list(search.QueryBlocks(sorted(files), 4, block)(8))) >= 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    for n in range(len(q)):
        want = [i for i, _ in brute(v, doc, q[n])[1:4]]
        scores = {i: float(v[i] @ q[n] / np.linalg.norm(v[i]) / np.linalg.norm(q[n])) for i in range(len(v))}
        page = sorted((r["rank"], r["chunk_id"]) for r in got if r["query_id"] == f"q{n}")
        assert np.allclose([scores[c] for _, c in page], [scores[i] for i in want]) and len(page) == len(want)


def test_depths_of_their_own(spark):
    chunks, v, doc = make_chunks(spark, 600)
    queries, q = make_queries(spark, 6)
    asked = queries.withColumns({"limit": F.substring("query_id", 2, 1).cast("int"), "offset": F.lit(1)})
    got = search.top_documents(chunks, docs(spark, range(201)), asked, assume_fk=True, block_bytes=200).collect()
    for n in range(6):
        page = sorted(r["rank"] for r in got if r["query_id"] == f"q{n}")
        assert page == list(range(2, 2 + n))


def test_null_query_vectors_find_nothing(spark):
    chunks, _, _ = make_chunks(spark, 60)
    rows = [(1, None), (2, [0.0] * 8), (3, [1.0] * 8)]
    q = spark.createDataFrame(rows, "query_id int, vector array<double>")
    got = search.best_candidates(chunks, q, 2).select("query_id").distinct().collect()
    assert [r[0] for r in got] == [3]


def test_missing_documents_take_no_places(spark):
    chunks, v, doc = make_chunks(spark)
    queries, q = make_queries(spark, 1)
    known = set(range(100, 201))
    got = search.top_documents(chunks, docs(spark, known), queries, 10, 0).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] and all(r["doc_id"] in known for r in got)
    want = brute(v, doc, q[0], known)[:10]
    scores = {i: float(v[i] @ q[0] / np.linalg.norm(v[i]) / np.linalg.norm(q[0])) for i in range(len(v))}
    assert np.allclose([scores[r["chunk_id"]] for r in got], [scores[i] for i, _ in want])


def test_ties_go_to_the_lower_id(spark):
    rows = [(i, i // 2, 0, 1, [1.0, 1.0]) for i in range(20)]
    chunks = spark.createDataFrame(rows, CHUNK).repartition(5)
    q = spark.createDataFrame([(1, "x", [2.0, 2.0])], "query_id int, query string, vector array<double>")
    for fk in (True, False):
        got = search.top_documents(chunks, docs(spark, range(10)), q, 3, 0, fk).orderBy("rank").collect()
        assert [r["chunk_id"] for r in got] == [0, 2, 4]


def test_null_and_zero_vectors_are_no_hits(spark):
    rows = [(1, 1, 0, 1, [1.0, 0.0]), (2, 2, 0, 1, None), (3, 3, 0, 1, [0.0, 0.0]), (4, None, 0, 1, [1.0, 0.0])]
    q = spark.createDataFrame([(1, "x", [1.0, 1.0])], "query_id int, query string, vector array<double>")
    got = search.best_candidates(spark.createDataFrame(rows, CHUNK), q, 5).collect()
    assert [r["chunk_id"] for r in got] == [1]


def test_wrong_length_is_an_error(spark):
    q = spark.createDataFrame([(1, "x", [1.0, 1.0])], "query_id int, query string, vector array<double>")
    bad = spark.createDataFrame([(1, 1, 0, 1, [1.0])], CHUNK)
    with pytest.raises(PySparkException):
        search.best_candidates(bad, q, 5).collect()


def test_no_queries_give_no_rows(spark):
    chunks, _, _ = make_chunks(spark, 30)
    queries, _ = make_queries(spark)
    assert search.top_documents(chunks, docs(spark, [1]), queries.limit(0), 5).count() == 0


@pytest.mark.parametrize(("limit", "offset"), [(-1, 0), (2**31, 0), (1, -1), (1, 2**31)])
def test_page_bounds(spark, limit, offset):
    with pytest.raises(ValueError):
        search.rank_page(spark.range(1), limit, offset)


def test_single_page_is_a_top_k_plan(spark):
    best = spark.range(100).select(F.col("id").alias("chunk_id"), (F.col("id") % 10).cast("double").alias("similarity"))
    got = search.rank_page(best, 3, 2).collect()
    assert [(r["chunk_id"]) for r in got] == [29, 39, 49]


def test_tasks_hand_on_no_more_than_a_page(spark):
    chunks, _, _ = make_chunks(spark)
    queries, _ = make_queries(spark, 2)
    kept = search.best_candidates(chunks, queries, 4).groupBy(F.spark_partition_id().alias("p"), "query_id").count()
    assert max(r["count"] for r in kept.collect()) <= 4


def test_vector_columns(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    r = df.select(
        vectors.dot(F.col("a"), F.col("b")), vectors.l2_norm(F.col("a")), vectors.cosine_similarity(F.col("a"), F.col("b")),
        vectors.l2_normalize(F.col("a")), vectors.cosine_similarity(F.col("a"), F.col("z")), vectors.l2_normalize(F.col("z")),
        vectors.cls_of(F.array("a", "b")),
    ).first()
    assert r[0] == 24 and r[1] == 5 and r[2] == pytest.approx(0.96) and r[3] == pytest.approx([0.6, 0.8])
    assert np.isnan(r[4]) and np.isnan(r[5]).all() and r[6] == [3.0, 4.0]
    with pytest.raises(PySparkException):
        df.select(vectors.dot(F.col("a"), F.slice("b", 1, 1))).collect()


def test_embed_texts(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, ""), (3, "x " * 600), (4, None)], "n int, text string")
    good, bad = embed.embed_texts(df)
    assert sorted(r["n"] for r in good.collect()) == [1, 3] and sorted(r["n"] for r in bad.collect()) == [2, 4]
    strict, turned = embed.embed_texts(df, cfg=embed.EmbedConfig(truncate=False))
    assert [r["n"] for r in strict.collect()] == [1]
    assert {r["n"]: r["reason"] for r in turned.collect()}[3] == "602 tokens, the model takes 512"


@pytest.mark.parametrize(("mean", "norm"), [(True, False), (True, True), (False, False)])
def test_hashing_model_pooling(spark, mean, norm):
    df = spark.createDataFrame([("a A b", )], "text string")
    v = np.array(embed.embed_column(df, "text", embed.EmbedConfig(mean_pooling=mean, normalize=norm)).first()["embedding"])
    weights = sorted(v[v > 0])
    want = {(True, False): [1 / 3, 2 / 3], (True, True): [1 / 5**0.5, 2 / 5**0.5], (False, False): [1.0]}[mean, norm]
    assert weights == pytest.approx(want)


def test_own_model_is_made_once_per_task_and_sees_small_batches(spark):
    def make(cfg):
        calls = []

        def encode(texts):
            calls.append(len(texts))
            return np.array([[len(t), len(calls), max(calls)] for t in texts])

        return encode

    df = spark.createDataFrame([("x" * i, ) for i in range(1, 11)], "text string").coalesce(1)
    got = embed.embed_column(df, "text", embed.EmbedConfig(make_model=make, dims=3, batch_rows=4)).collect()
    assert sorted(tuple(r["embedding"]) for r in got)[-1] == (10.0, 3.0, 4.0)


def test_index_and_search_end_to_end(spark, rows):
    texts = [("d1", "spark joins tables"), ("d2", "cats chase mice " * 300), ("d3", ""), ("d4", None)]
    table = spark.createDataFrame([(d, f"http://{d}/", t, "") for d, t in texts], "doc_id string, url string, content string, title string")
    chunks, missing = index_ids(table.select("doc_id").union(spark.createDataFrame([("d9",)], "doc_id string")), table, F.expr("timestamp'2024-01-01'"))
    assert rows(chunks.groupBy("doc_id").count()) == [("d1", 1), ("d2", 2)]
    assert rows(missing, "doc_id") == [("d4",), ("d9",)]
    again = index_documents(table, F.expr("timestamp'2024-01-01'"))
    assert rows(again, "chunk_id") == rows(chunks, "chunk_id")
    queries = spark.createDataFrame([(1, "Cats and mice"), (2, "tables"), (3, "")], "query_id int, query string")
    found = run_search(chunks, table, queries, 1)
    assert rows(found, "query_id", "url") == [(1, "http://d2/"), (2, "http://d1/")]
    sliced = embed.chunk_arrays(chunks).collect()
    assert all(len(r["chunk_id"]) == len(r["embedding"]) for r in sliced)


def test_tokenizer_plug_in_makes_the_same_chunks(spark, rows):
    import re

    find = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]").finditer
    df = spark.createDataFrame([(1, "a b, c " * 400), (2, "x")], "doc_id int, content string")
    own = embed.EmbedConfig(tokenizer=lambda t: [(m.group(), *m.span()) for m in find(t)])
    cols = ("doc_id", "chunk_no", "chunk_start", "chunk_end", "embedding")
    assert rows(embed.embed_chunks(df, "content", own), *cols) == rows(embed.embed_chunks(df, "content"), *cols)
