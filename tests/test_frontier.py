import datetime as dt

import pytest
from pyspark.sql import functions as F

from trawlspark.operators import frontier as fr
from trawlspark.operators import robots
from trawlspark.operators.ranking import row_number_within
from trawlspark.plans.crawl import crawl_round
from trawlspark.sources.messages import read_messages

T = dt.datetime(2024, 1, 1)


def now():
    return F.expr("timestamp'2024-01-09 00:00:00'")


def queue(spark, *rows):
    data = [(i, u, h, d, T + dt.timedelta(minutes=m)) for i, u, h, d, m in rows]
    return spark.createDataFrame(data, "url_id long, url string, host string, depth int, created_at timestamp")


def sites(spark, *rows):
    return spark.createDataFrame(list(rows), "host string, depth int, interval_s double")


def test_dequeue_takes_the_oldest_of_each_configured_host(spark, rows):
    q = queue(
        spark, (1, "http://a/1", "a", 0, 5), (2, "http://a/2", "a", 0, 1), (3, "http://a/3", "a", 0, 1), (4, "http://b/", "b", 0, 0),
        (5, "http://c/", "c", 0, 0),
    )
    taken, rest = fr.dequeue(q, sites(spark, ("a", 2, 1.0), ("c", 2, 1.0)), 2)
    assert [r[0] for r in rows(taken, "url_id")] == [2, 3, 5]
    assert [r[0] for r in rows(rest, "url_id")] == [1, 4]
    assert fr.requeue(rest, taken).count() == 5


def test_dequeue_hands_on_no_invalid_url(spark, rows):
    q = queue(spark, (1, "no url", "a", 0, 0), (2, "http://a/2", "a", 0, 1))
    taken, rest = fr.dequeue(q, sites(spark, ("a", 2, 1.0)), 2)
    assert rows(taken, "url_id") == [(2,)] and rest.count() == 0


def test_refill_stops_at_the_cap(spark):
    held = queue(spark, *[(i, f"u{i}", "a", 0, 0) for i in range(3)])
    assert fr.refill(held, held, cap=3).count() == 3
    assert fr.refill(held, held, cap=4).count() == 6


def test_enqueue_is_insert_if_absent(spark, rows):
    q = queue(spark, (1, "x", "a", 0, 0))
    links = spark.createDataFrame([("x", "a", 1), ("y", "a", 3), ("y", "a", 2), ("z", "a", 1)], "url string, host string, depth int")
    assert rows(fr.enqueue_links(q, links, now()), "url", "depth") == [("y", 2), ("z", 1)]
    assert fr.enqueue_links(q.limit(0), links, now()).count() == 3


def test_visits_expire(spark, rows):
    q = queue(spark, (1, "a", "h", 0, 0), (2, "b", "h", 0, 0), (3, "c", "h", 0, 0))
    seen = spark.createDataFrame(
        [("a", T + dt.timedelta(days=1)), ("b", T + dt.timedelta(days=1, seconds=1)), ("b", T)], "url string, visited_at timestamp")
    assert rows(fr.not_visited(q, seen, now()), "url") == [("a",), ("c",)]


def test_admission_reasons_come_in_order(spark):
    q = queue(
        spark, (1, "mailto:x", None, 9, 0), (2, "http://no/", "no", 9, 0), (3, "http://h/x", "h", 2, 0),
        (4, "http://h/x", "h", 1, 0), (5, "http://h/v", "h", 1, 0), (6, "http://h/a", "h", 1, 2), (7, "http://h/b", "h", 1, 1),
        (8, "http://n/deep", "n", 99, 0),
    )
    rules = robots.parse_robots(spark.createDataFrame(
        [("h", 200, f"User-agent: {robots.DEFAULT_AGENT}\nDisallow: /x")], "host string, status int, body string"))
    seen = spark.createDataFrame([("http://h/v", T + dt.timedelta(days=7)), ("http://h/x", T + dt.timedelta(days=7))], "url string, visited_at timestamp")
    table = sites(spark, ("h", 2, 1.0), ("n", None, 0.5))
    want = {1: fr.NO_HOST, 2: fr.NOT_CONFIGURED, 3: fr.TOO_DEEP, 4: fr.FORBIDDEN, 5: fr.VISITED, 6: fr.TOO_FAST, 7: fr.PASSED, 8: fr.PASSED}
    for bound in (None, 10):
        got = fr.admit(q, table, rules, seen, now(), round_s=1.0, max_per_host=bound).collect()
        assert {r["url_id"]: r["reason"] for r in got} == want
        assert all(r["ok"] == (r["reason"] == fr.PASSED) for r in got)
    free = fr.admit(q, table, rules, seen, now())
    assert {r["url_id"]: r["reason"] for r in free.collect()} == {**want, 6: fr.PASSED}


@pytest.mark.parametrize(
    ("header", "outputs"),
    [
        ("text/html; charset=utf-8", {"page", "visited"}),
        ("TEXT/PLAIN", {"page", "visited"}),
        ("image/png", {"visited"}),
        (None, {"visited"}),
        ("bad", {"error"}),
        ("text/", {"error"}),
        ("textual/x", {"visited"}),
        ("", {"error"}),
    ],
)
def test_content_type_gate(spark, header, outputs):
    df = spark.createDataFrame([("u", header)], "url string, content_type string")
    got = {n for n, d in zip(("page", "visited", "error"), fr.gate_content_type(df)) if d.count()}
    assert got == outputs


def test_payload_dies_after_ten_minutes(spark, rows):
    put = spark.createDataFrame([("a", T), ("b", T)], "id string, put_ts timestamp")
    ids = spark.createDataFrame(
        [("a", T + dt.timedelta(seconds=599)), ("b", T + dt.timedelta(seconds=600)), ("c", T)], "id string, get_ts timestamp")
    found, missing = fr.lookup_payloads(ids, put)
    assert rows(found, "id") == [("a",)] and rows(missing, "id") == [("b",), ("c",)]


def test_row_numbers_of_a_hot_group_span_partitions(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 500)).alias("host"),
        F.lit(T).alias("created_at"), F.xxhash64("id").alias("k"), F.col("id").alias("url_id"))
    got = row_number_within(df, ["host"], [F.col("created_at"), F.col("k")], partitions=8)
    want = df.selectExpr("url_id", "row_number() over (partition by host order by created_at, k) as w")
    both = got.join(want, "url_id")
    assert both.count() == 20000 and both.filter("rn <> w").count() == 0
    parts = got.filter("host = 'hot'").select(F.col("rn")).count()
    assert parts == 6667


def test_pace_is_one_interval_apart(spark, rows):
    q = queue(spark, (1, "http://h/1", "h", 0, 2), (2, "http://h/2", "h", 0, 1), (3, "http://g/", "g", 0, 0))
    table = sites(spark, ("h", 1, 0.5), ("x", 1, 1.0))
    for bound in (None, 5):
        got = fr.pace_schedule(q, table, F.lit(T), bound)
        assert rows(got, "url_id", F.unix_millis("fetch_at") - F.unix_millis(F.lit(T))) == [(1, 1000), (2, 500)]


def test_crawl_round(spark, rows):
    q = queue(spark, (1, "http://h/1", "h", 0, 1), (2, "http://h/2", "h", 0, 2), (3, "http://h/3", "h", 0, 3),
              (4, "http://h/4", "h", 0, 4), (5, "http://h/5", "h", 0, 5), (6, "http://x/", "x", 0, 0))
    answers = spark.createDataFrame(
        [("http://h/1", 404, "text/html", "<p>1"), ("http://h/2", 200, "image/gif", ""), ("http://h/9", 200, "text/html", "")],
        "url string, status int, content_type string, body string")
    none = spark.createDataFrame([], "host string, agent string, kind string, prefix string, section int, pos int")
    seen = spark.createDataFrame([], "url string, visited_at timestamp")
    out = crawl_round(q, sites(spark, ("h", 2, 1.0)), none, seen, answers, now(), batch=4, round_s=3.0)
    messages, bad = read_messages(out.messages.drop("id"))
    assert rows(messages, "url", "content", "depth") == [("http://h/1", "<p>1", 0)] and bad.count() == 0
    assert rows(out.visits, "url") == [("http://h/1",), ("http://h/2",)]
    assert rows(out.failed, "url") == [("http://h/3",)]  # no answer: gone, not marked visited
    assert rows(out.frontier, "url_id") == [(4,), (5,), (6,)]  # 4 was too fast, 5 not taken, 6 not configured
    assert out.errors.count() == 0


def test_bad_messages_are_rejected(spark):
    df = spark.createDataFrame([(1, "{"), (2, '{"id": "a"}'), (3, None), (4, '{"id":"a","content":"","depth":0,"url":"u"}')], "n int, message string")
    good, bad = read_messages(df)
    assert [r["n"] for r in good.collect()] == [4] and sorted(r["n"] for r in bad.collect()) == [1, 2, 3]
