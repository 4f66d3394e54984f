import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trawlspark.functions.ids import new_id
from trawlspark.operators import arrays, documents, kv
from trawlspark.plans.index import replace_chunks
from trawlspark.sources.tables import create_tables, drop_tables

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
DOC = "doc_id string, url string, title string, content string"


def table(spark, *rows):
    return spark.createDataFrame([(*r, T0, T0) for r in rows], DOC + ", created_at timestamp, updated_at timestamp")


@pytest.mark.parametrize(("mode", "text"), [("new", "C2"), ("url", "u1")])
def test_upsert(spark, rows, mode, text):
    old = table(spark, ("1", "u1", "t1", "c1"), ("2", "u2", "t2", "c2"))
    new = spark.createDataFrame([("8", "u1", "T", "C"), ("9", "u1", "T2", "C2"), ("7", "u3", "t3", "c3")], DOC)
    got, ids = documents.upsert_documents(old, new, F.lit(T1), mode)
    assert rows(got, "doc_id", "url", "title", "content", "created_at", "updated_at") == [
        ("1", "u1", "t1", text, T0, T1), ("2", "u2", "t2", "c2", T0, T0), ("7", "u3", "t3", "c3", T1, T1)]
    assert rows(ids, "url", "doc_id") == [("u1", "1"), ("u3", "7")]


def test_upsert_twice_in_one_batch_updates_the_first(spark, rows):
    new = spark.createDataFrame([("8", "u", "T", "C"), ("9", "u", "T2", "C2")], DOC)
    got, ids = documents.upsert_documents(table(spark).limit(0), new, F.lit(T1))
    assert rows(got, "doc_id", "title", "content") == [("8", "T", "C2")] and rows(ids, "doc_id") == [("8",)]


def test_lookup_reports_both_errors(spark, rows):
    docs = spark.createDataFrame([("1", "u", "t", "c"), ("2", "u2", "t", None)], DOC)
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "doc_id string")
    found, missing = documents.lookup_documents(ids, docs)
    assert rows(found, "doc_id", "content") == [("1", "c")]
    assert rows(missing) == [("2", "document without content"), ("3", "no document found")]


@pytest.mark.parametrize(
    ("chunk_docs", "strict", "safe"),
    [([], ["1", "2"], ["1", "2"]), (["1"], ["2"], ["2"]), (["1", None], [], ["2"]), ([None], [], ["1", "2"])],
)
def test_missing_documents_and_nulls(spark, rows, chunk_docs, strict, safe):
    docs = spark.createDataFrame([("1",), ("2",)], "doc_id string")
    chunks = spark.createDataFrame([(c,) for c in chunk_docs], "doc_id string")
    assert [r[0] for r in rows(documents.missing_documents(docs, chunks))] == strict
    assert [r[0] for r in rows(documents.missing_documents(docs, chunks, null_safe=True))] == safe


def test_orphans_and_cascade(spark, rows):
    docs = spark.createDataFrame([("1",), ("2",)], "doc_id string")
    chunks = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", None)], "chunk_id string, doc_id string")
    assert rows(documents.orphan_chunks(chunks, docs), "chunk_id") == [("c",)]
    left, kept = documents.delete_documents(docs, chunks, docs.filter("doc_id = '1'"))
    assert rows(left) == [("2",)] and rows(kept, "chunk_id") == [("b",), ("c",), ("d",)]


def log(spark, *rows):
    data = [(k, op, s, v.encode() if v else None, T0 + dt.timedelta(seconds=t), ttl) for k, op, s, v, t, ttl in rows]
    return spark.createDataFrame(data, "key string, op string, seq int, value binary, ts timestamp, ttl_s int")


def at(seconds):
    return F.lit(T0 + dt.timedelta(seconds=seconds))


def test_cache_round_trip(spark):
    key = spark.createDataFrame([("test_key",)], "key string")
    entries = key.select("key", F.lit(b"test_value").alias("value"), F.lit(1).alias("seq"))
    stored = kv.kv_set(entries, at(0))
    assert kv.kv_exists(key, stored, at(1)).count() == 1
    assert bytes(kv.kv_get(key, stored, at(1)).first()["value"]) == b"test_value"
    gone = stored.unionByName(kv.kv_del(entries.withColumn("seq", F.lit(2)), at(1)))
    assert kv.kv_get(key, gone, at(1)).first()["value"] is None
    assert kv.kv_exists(key, gone, at(1)).count() == 0


def test_cache_expiry_and_last_write(spark, rows):
    entries = log(spark, ("a", "set", 1, "x", 0, 10), ("b", "set", 1, "x", 0, 10), ("b", "set", 2, "y", 0, None),
                  ("c", "set", 1, "x", 0, 10), ("c", "set", 2, "z", 5, 10), ("d", "set", 1, "f", 50, None))
    assert rows(kv.kv_latest(entries, at(9)), "key") == [("a",), ("b",), ("c",)]
    assert rows(kv.kv_latest(entries, at(10)), "key") == [("b",), ("c",)]
    assert rows(kv.kv_latest(entries, at(15)), "key") == [("b",)]


def test_ids_sort_by_time_and_repeat(spark):
    df = spark.createDataFrame([(T0, "a"), (T1, "a"), (T1, "b")], "t timestamp, k string")
    ids = [r[0] for r in df.orderBy("t", "k").select(new_id(F.col("t"), F.col("k"))).collect()]
    assert all(len(i) == 26 for i in ids) and ids[0] < min(ids[1:]) and len(set(ids)) == 3
    assert ids == [r[0] for r in df.orderBy("t", "k").select(new_id(F.col("t"), F.col("k"))).collect()]


def test_pooling_and_arrays(spark):
    df = spark.createDataFrame([("a", 0, [1.0, 2.0]), ("a", 1, [3.0, 6.0]), ("b", 5, [1.0, 1.0])], "k string, pos int, embedding array<float>")
    mean = {r[0]: list(r[1]) for r in arrays.mean_pool(df, "k").collect()}
    assert mean == {"a": [2.0, 4.0], "b": [1.0, 1.0]}
    assert {r[0]: list(r[1]) for r in arrays.cls_pool(df, "k", "pos").collect()} == {"a": [1.0, 2.0], "b": [1.0, 1.0]}
    packed = arrays.collect_arrays(df, "k", "pos", "pos", "embedding")
    assert arrays.unnest(packed, "pos", "embedding", keep=["k"]).count() == 3
    counted, seen = arrays.observed(df, "n", F.col("k") == "b")
    counted.collect()
    assert seen.get == {"rows": 3, "failed": 1}


@pytest.mark.parametrize("buckets", [0, 4])
def test_tables(spark, rows, tmp_path, buckets):
    db = f"trawl_test_{buckets}"
    tables = create_tables(spark, db, str(tmp_path / "db"), buckets)
    create_tables(spark, db, str(tmp_path / "db"), buckets)
    doc = spark.createDataFrame([("1", "u1", "t", "c"), ("2", "u2", "t", "c")], DOC)
    tables.upsert_documents(doc, F.lit(T0))
    tables.upsert_documents(doc.limit(1).withColumn("content", F.lit("n")), F.lit(T1))
    assert tables.document("1").first()["content"] == "n" and tables.documents.count() == 2
    touched = tables.parts_of("documents", doc.limit(1))
    plan = tables.read("documents", touched)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan and len(touched) == 1
    chunk = spark.createDataFrame([("x", "1", 0, 4, [1.0, 0.0]), ("y", "2", 0, 4, [1.0, 1.0])],
                                  "chunk_id string, doc_id string, chunk_start long, chunk_end long, embedding array<float>")
    stamped = chunk.withColumns({"created_at": F.lit(T0), "updated_at": F.lit(T0)})
    tables.append_chunks(stamped, 2)
    assert tables.orphans().count() == 0
    for bad in (
        stamped.withColumn("doc_id", F.lit("9")),
        stamped.withColumn("embedding", F.array(F.lit(1.0))),
        stamped.withColumn("embedding", F.array(F.lit(0.0), F.lit(0.0))),
        stamped.withColumn("embedding", F.lit(None).cast("array<float>")),
    ):
        with pytest.raises((PySparkException, ValueError)):
            tables.append_chunks(bad, 2)
    links = spark.createDataFrame([("a", "h", 1), ("b", "h", 1)], "url string, host string, depth int")
    tables.append_links(links, F.lit(T0))
    tables.append_links(links.unionByName(links.withColumn("url", F.lit("c"))), F.lit(T1))
    ids = [r[0] for r in rows(tables.frontier, "url_id")]
    assert len(ids) == len(set(ids)) == 3
    fresh = replace_chunks(tables.chunks, stamped.limit(1).withColumn("chunk_id", F.lit("z")))
    assert rows(fresh, "chunk_id") == [("y",), ("z",)]
    tables.delete_documents(doc.filter("doc_id = '1'"))
    assert rows(tables.chunks, "chunk_id") == [("y",)] and rows(tables.documents, "doc_id") == [("2",)]
    drop_tables(spark, db)
    spark.sql(f"DROP DATABASE {db}")
