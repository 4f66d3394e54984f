import datetime as dt
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawlspark.operators import frontier
from trawlspark.operators.embed import EmbedConfig
from trawlspark.operators.robots import DEFAULT_AGENT
from trawlspark.session import fresh_dir
from trawlspark.sources.queues import read_ids, write_ids
from trawlspark.streaming import ordered, rules
from trawlspark.streaming.stages import StageTables, crawl_batch, embed_batch, parse_batch, start_crawl, start_embed, start_parse

ONCE = {"availableNow": True}
T0 = dt.datetime(2024, 1, 1)


def now():
    return F.expr("timestamp'2024-01-09 00:00:00'")


def feed(spark, folder, schema, *batches):
    """One file per batch, read back one file per trigger in that order."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/f{n}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def drain(spark, stream):
    home = fresh_dir(spark, "out")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{home}/c").trigger(**ONCE).start(f"{home}/o").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/o")


MESSAGE = "id string, content string, depth int, url string"


def page(body, *hrefs):
    return f"<title>T</title><body>{body}" + "".join(f"<a href='{h}'>l</a>" for h in hrefs)


@pytest.fixture
def sites(spark):
    return spark.createDataFrame([("h.org",)], "host string")


def test_parse_stage_keeps_identity_over_batches(spark, rows, sites, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    stream = feed(
        spark, str(tmp_path / "in"), MESSAGE,
        [("m1", page("one", "/a", "/a", "http://other/", "mailto:x"), 0, "http://h.org/1"), ("m2", "<body></body>", 0, "http://h.org/2"), ("", "x", 0, "u")],
        [("m3", page("two", "/a", "/b"), 1, "http://h.org/1"), ("m4", page("four"), 1, "http://h.org/4"), ("m5", page("five"), 1, "http://h.org/4")],
    )
    start_parse(stream, tables, sites, str(tmp_path / "c"), now(), ONCE).awaitTermination()
    docs = {r["url"]: r for r in tables.documents().collect()}
    assert set(docs) == {"http://h.org/1", "http://h.org/4"}
    assert docs["http://h.org/1"]["content"] == "T two l l" and docs["http://h.org/4"]["content"] == "T five"
    log = tables.read("documents").filter("url = 'http://h.org/1'")
    assert log.count() == 2 and log.select("doc_id").distinct().count() == 1
    assert rows(tables.read("frontier"), "url", "depth") == [("http://h.org/a", 1), ("http://h.org/b", 2)]
    assert rows(tables.read("rejects"), "id", "reason") == [("", "empty id"), ("m2", "page without body text")]
    assert tables.read("doc_ids").count() == 3


def test_replayed_batch_changes_nothing(spark, rows, sites, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    run = parse_batch(tables, sites, now())
    first = spark.createDataFrame([("m1", page("one", "/a"), 0, "http://h.org/1")], MESSAGE)
    second = spark.createDataFrame([("m2", page("two", "/b"), 0, "http://h.org/1")], MESSAGE)
    run(first, 0)
    run(second, 1)
    before = [rows(tables.read(n).drop("batch_id")) for n in ("documents", "frontier", "doc_ids")]
    run(second, 1)
    assert [rows(tables.read(n).drop("batch_id")) for n in ("documents", "frontier", "doc_ids")] == before
    embed = embed_batch(tables, now(), EmbedConfig())
    ids = tables.read("doc_ids").select("id", "event_time")
    embed(ids, 0)
    chunks = rows(tables.read("chunks"), "chunk_id")
    embed(ids, 0)
    assert rows(tables.read("chunks"), "chunk_id") == chunks and len(chunks) == 1


def test_stages_chain_by_their_queue(spark, rows, sites, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    stream = feed(spark, str(tmp_path / "in"), MESSAGE, [("m1", page("one " * 600), 0, "http://h.org/1")], [("m2", page("two"), 0, "http://h.org/2")])
    start_parse(stream, tables, sites, str(tmp_path / "c"), now(), ONCE).awaitTermination()
    start_embed(read_ids(spark, tables.path("doc_ids")), tables, str(tmp_path / "c2"), now(), trigger=ONCE).awaitTermination()
    assert rows(tables.read("chunks").groupBy("doc_id").count().select("count")) == [(1,), (2,)]


def test_unknown_ids_go_to_rejects(spark, rows, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    queue = str(tmp_path / "q")
    write_ids(spark.createDataFrame([("nope", T0)], "id string, event_time timestamp"), queue)
    start_embed(read_ids(spark, queue), tables, str(tmp_path / "c"), now(), trigger=ONCE).awaitTermination()
    assert rows(spark.read.parquet(f"{tables.root}/embed_rejects"), "id", "reason") == [("nope", "no document found")]


EVENT = "host string, ts timestamp, seq long"


def spaced_by_hand(events, wait, strict):
    last, out = {}, {}
    for host, ts, seq in sorted(events, key=lambda e: (e[1], e[2])):
        gap = (ts - last[host]).total_seconds() if host in last else None
        out[seq] = gap is None or (gap > wait if strict else gap >= wait)
        if out[seq]:
            last[host] = ts
    return out


def test_rate_limit_and_visits_over_batches(spark, tmp_path):
    rng = random.Random(4)
    events = [(rng.choice("abc"), T0 + dt.timedelta(seconds=rng.randint(0, 300)), i) for i in range(300)]
    events.sort(key=lambda e: (e[1], e[2]))
    stream = feed(spark, str(tmp_path / "in"), EVENT, events[:100], events[100:200], events[200:])
    got = {r["seq"]: r["accepted"] for r in drain(spark, rules.rate_limit_stream(stream, 5.0)).collect()}
    assert got == spaced_by_hand(events, 5, True)
    stream = stream.withColumnRenamed("host", "url")
    got = {r["seq"]: r["fresh"] for r in drain(spark, rules.first_visit_stream(stream, 20)).collect()}
    assert got == spaced_by_hand(events, 20, False)


def timed_events(spark, tmp_path, n=300, columns="host string, ts timestamp, seq long"):
    """Events of three keys over three triggers, some out of order by up to 20 seconds, and a last one that moves the watermark."""
    rng = random.Random(9)
    events = [(rng.choice("aab"), T0 + dt.timedelta(seconds=rng.randint(0, 300), microseconds=rng.randint(0, 999_999)), i) for i in range(n)]
    events += [("c", T0 + dt.timedelta(seconds=5), n), ("c", T0 + dt.timedelta(seconds=5), n + 1)]  # one time, two rows
    events.sort(key=lambda e: e[1] + dt.timedelta(seconds=rng.randint(0, 20)))
    far = [("z", T0 + dt.timedelta(days=3650), -1)]
    return events, feed(spark, str(tmp_path / "timed"), columns, events[:100], events[100:200], events[200:], far)


def drained_states(spark, stream):
    home = fresh_dir(spark, "out")
    with ordered.timer_state(spark):
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{home}/c").trigger(**ONCE).start(f"{home}/o")
        query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    return spark.read.parquet(f"{home}/o").filter("seq >= 0").collect(), states


def test_deferred_rows_come_out_by_themselves(spark, tmp_path):
    events, stream = timed_events(spark, tmp_path)
    got, states = drained_states(spark, ordered.paced_stream(stream, 5.0, delay="30 seconds"))
    want, free = {}, {}
    for host, ts, seq in sorted(events, key=lambda e: (e[1], e[2])):
        want[seq] = max(ts, free.get(host, ts))
        free[host] = want[seq] + dt.timedelta(seconds=5)
    assert len(got) == len(events) and {r["seq"]: r["released_at"] for r in got} == want
    assert max(states) > 100 and states[-1] <= 4  # state falls again; the last row waits, with its timer


def test_visits_expire_in_time_order(spark, tmp_path):
    events, stream = timed_events(spark, tmp_path)
    got, states = drained_states(spark, ordered.expiring_visits(stream.withColumnRenamed("host", "url"), "20 seconds", delay="30 seconds"))
    assert {r["seq"]: r["fresh"] for r in got} == spaced_by_hand(events, 20, False)
    assert states[-1] <= 4


def test_rows_of_one_time_and_rows_behind_a_long_queue_keep_their_turn(spark, tmp_path):
    """A hot key over several runs and triggers, many rows of one time, and rows that overtake those which wait."""
    rng = random.Random(5)
    times = [T0 + dt.timedelta(seconds=rng.randint(0, 40)) for _ in range(3000)]
    events = sorted((("hot" if i % 3 else f"k{i % 40}"), at, i) for i, at in enumerate(times))
    events.sort(key=lambda e: e[1] + dt.timedelta(seconds=rng.randint(0, 8)))
    far = [("z", T0 + dt.timedelta(days=3650), -1)]
    stream = feed(spark, str(tmp_path / "in"), EVENT, *(events[at : at + 1000] for at in range(0, 3000, 1000)), far)
    got, states = drained_states(spark, ordered.paced_stream(stream, 0.5, delay="30 seconds"))
    want, free = {}, {}
    for host, ts, seq in sorted(events, key=lambda e: (e[1], e[2])):
        want[seq] = max(ts, free.get(host, ts))
        free[host] = want[seq] + dt.timedelta(seconds=0.5)
    assert len(got) == len(events) and {r["seq"]: r["released_at"] for r in got} == want
    assert max(states) < 2 * len(events) / 3 and states[-1] <= 4  # rows that came together share entries


def test_runs_are_read_a_part_at_a_time():
    """The rule itself, with state in plain dicts: runs shorter than a trigger's rows, one part of each read at once."""

    class Value:
        kept = None

        def get(self):
            return self.kept

        def update(self, v):
            self.kept = v

        def clear(self):
            self.kept = None

    class Map(dict):
        calls = 0

        def updateValue(self, k, v):
            self.calls += 1
            self[k] = v

        def getValue(self, k):
            self.calls += 1
            return self[k]

        def removeKey(self, k):
            self.calls += 1
            del self[k]

    class Handle:
        def __init__(self):
            self.timers, self.book, self.parts = set(), Value(), Map()

        def getValueState(self, *_):
            return self.book

        def getMapState(self, *_):
            return self.parts

        def registerTimer(self, ms):
            self.timers.add(ms)

    class At:
        def __init__(self, ms):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms

    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType())])
    rng, second = random.Random(6), dt.timedelta(seconds=1)
    rows = [Row(host="h", ts=T0 + rng.randint(0, 50) * second, seq=i) for i in range(40_000)]
    rule, handle = ordered.Visits(schema, 7_000_000), Handle()
    rule.init(handle)
    assert list(rule.handleInputRows(("h",), iter(rows), None)) == []
    assert len(handle.timers) == 1 and handle.parts.calls < 300  # before: three calls a row and a timer for each time
    out = []
    while handle.timers:
        at = min(handle.timers)
        handle.timers.discard(at)
        out += rule.handleExpiredTimer(("h",), At(at + 20_000), At(at))
    assert [(r["ts"], r["seq"]) for r in out] == sorted((r["ts"], r["seq"]) for r in rows)
    assert {r["seq"]: r["fresh"] for r in out} == spaced_by_hand([tuple(r) for r in rows], 7, False)
    assert handle.book.kept is None and not handle.parts and handle.parts.calls < 2_000


def test_pace_of_less_than_a_millisecond_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        ordered.paced_stream(timed_events(spark, tmp_path)[1], 0.0001)


def test_ids_without_a_page_come_out_with_a_reason(spark, rows, tmp_path):
    s = dt.timedelta(seconds=1)
    far = T0 + dt.timedelta(days=3650)
    put = feed(spark, str(tmp_path / "p"), "id string, put_ts timestamp, body string", [("a", T0, "A"), ("b", T0, "B")], [("c", T0 + 60 * s, "C")], [("z", far, "Z")])
    asked = [[("a", T0 + 599 * s), ("c", T0 + 59 * s)], [("b", T0 + 600 * s), ("c", T0 + 61 * s), ("x", T0), ("x", T0)], [("z", far + 3600 * s)]]
    ids = feed(spark, str(tmp_path / "i"), "id string, get_ts timestamp", *asked)
    got = drain(spark, rules.payload_or_error_stream(ids, put, delay="20 minutes")).filter("id <> 'z'")
    no = rules.NO_PAGE
    want = [("a", "A", None), ("b", None, no), ("c", "C", None), ("c", None, no), ("x", None, no), ("x", None, no)]
    assert rows(got, "id", "body", "reason") == sorted(want, key=repr)


def test_visits_drop_repeats(spark, rows, tmp_path):
    day = dt.timedelta(days=1)
    stream = feed(spark, str(tmp_path / "in"), "url string, ts timestamp", [("a", T0), ("b", T0)], [("a", T0 + day), ("c", T0 + day)])
    assert rows(drain(spark, rules.visited_stream(stream)), "url") == [("a",), ("b",), ("c",)]


def test_payload_join_over_batches(spark, rows, tmp_path):
    s = dt.timedelta(seconds=1)
    put = feed(spark, str(tmp_path / "p"), "id string, put_ts timestamp, body string", [("a", T0, "A"), ("b", T0, "B")], [("c", T0 + 60 * s, "C")])
    ids = feed(spark, str(tmp_path / "i"), "id string, get_ts timestamp", [("a", T0 + 599 * s)], [("b", T0 + 600 * s), ("c", T0 + 61 * s), ("x", T0)])
    assert rows(drain(spark, rules.payload_stream(ids, put)), "id", "body") == [("a", "A"), ("c", "C")]


def test_crawl_rounds_feed_the_parser(spark, rows, tmp_path):
    """Two rounds at two links per host: the queue moves on, visits hold, found links join the queue."""
    tables = StageTables(spark, str(tmp_path / "t"))
    minute = dt.timedelta(minutes=1)
    queue = [(f"http://h.org/{i}", "h.org", 0, T0 + i * minute, T0) for i in range(5)]
    tables.write("frontier", 0, spark.createDataFrame(
        queue, "url string, host string, depth int, created_at timestamp, updated_at timestamp"))
    answer = "url string, status int, content_type string, body string"
    responses = feed(
        spark, str(tmp_path / "r"), answer,
        [("http://h.org/0", 200, "text/html", page("zero", "/new", "/3")), ("http://h.org/1", 200, "image/png", "")],
        [("http://h.org/2", 200, "text/html", page("two"))],
    )
    sites = spark.createDataFrame([("h.org", 3, 1.0)], "host string, depth int, interval_s double")
    rules_table = spark.createDataFrame([], "host string, agent string, kind string, prefix string, section int, pos int")
    start_crawl(responses, tables, sites, rules_table, str(tmp_path / "c"), now(), ONCE, per_host=2).awaitTermination()
    assert rows(tables.read("taken"), "url") == [(f"http://h.org/{i}",) for i in range(4)]
    assert rows(tables.read("visits"), "url") == [(f"http://h.org/{i}",) for i in range(3)]
    assert rows(tables.frontier(), "url") == [("http://h.org/4",)]
    start_parse(tables.messages(), tables, sites, str(tmp_path / "c2"), now(), ONCE).awaitTermination()
    assert rows(tables.documents(), "url") == [("http://h.org/0",), ("http://h.org/2",)]


def test_answers_of_any_trigger_count(spark, rows, tmp_path):
    """Early answers wait for their round, late ones find their link, and nothing is lost."""
    tables = StageTables(spark, str(tmp_path / "t"))
    minute = dt.timedelta(minutes=1)
    queue = [(f"http://h.org/{i}", "h.org", 0, T0 + i * minute, T0) for i in range(6)]
    tables.write("frontier", 0, spark.createDataFrame(queue, "url string, host string, depth int, created_at timestamp, updated_at timestamp"))
    html = ("text/html", page("x"))
    responses = feed(
        spark, str(tmp_path / "r"), "url string, status int, content_type string, body string",
        [("http://h.org/5", 200, *html), ("http://H.org:80/4", 200, *html), ("http://x.org/", 200, *html)],
        [("http://h.org/0", 200, *html), ("http://h.org/1", 200, "bad", "")],
        [("http://h.org/2", 200, "image/png", ""), ("http://h.org/2", 200, "image/png", "again")],
    )
    sites = spark.createDataFrame([("h.org", 3, 1.0)], "host string, depth int, interval_s double")
    rules_table = spark.createDataFrame([], "host string, agent string, kind string, prefix string, section int, pos int")
    start_crawl(responses, tables, sites, rules_table, str(tmp_path / "c"), now(), ONCE, per_host=2).awaitTermination()
    assert rows(tables.read("visits"), "url") == [(f"http://h.org/{i}",) for i in (0, 2, 4, 5)]
    assert rows(tables.read("crawl_rejects"), "url", "reason") == [
        ("http://h.org/1", "unreadable content type"), ("http://h.org/2", "answered before"), ("http://x.org/", "not asked for"),
    ]
    assert rows(tables.waiting(9), "url") == [("http://h.org/3",)] and tables.held(9).count() == 0 and tables.frontier().count() == 0
    # A week later the link without an answer is given up.
    crawl_batch(tables, sites, rules_table, F.expr("timestamp'2024-02-01 00:00:00'"))(responses_none(spark), 9)
    assert ("http://h.org/3", "no answer") in rows(tables.read("crawl_rejects"), "url", "reason") and tables.waiting(10).count() == 0


def responses_none(spark):
    return spark.createDataFrame([], "url string, status int, content_type string, body string")


def test_replay_with_the_stored_time(spark, rows, sites, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    run, embed = parse_batch(tables, sites), embed_batch(tables)
    first = spark.createDataFrame([("m1", page("one", "/a"), 0, "http://h.org/1")], MESSAGE)
    names = ("documents", "frontier", "doc_ids", "chunks")
    seen = []
    for _ in range(2):
        run(first, 0)
        embed(tables.read("doc_ids").select("id", "event_time"), 0)
        seen.append([rows(tables.read(n)) for n in names])
    assert seen[0] == seen[1] and len(seen[0][3]) == 1


def test_bad_lines_empty_texts_and_bad_vectors_are_rejects(spark, rows, sites, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    parse_batch(tables, sites, now())(spark.createDataFrame([("{not json",), ('{"id": "a"}',)], "message string"), 0)
    assert rows(tables.read("rejects"), "reason") == [("bad message",)] * 2
    docs = [("1", "http://h.org/1", "", "t"), ("2", "http://h.org/2", "words", "t"), ("3", "http://h.org/3", "other", "t")]
    frame = spark.createDataFrame(docs, "doc_id string, url string, content string, title string")
    tables.write("documents", 0, frame.withColumns({"created_at": now(), "updated_at": now()}))
    import numpy as np

    cfg = EmbedConfig(make_model=lambda _: lambda texts: np.array([[float("other" not in t)] * 64 for t in texts]))
    embed_batch(tables, now(), cfg)(spark.createDataFrame([("1",), ("2",), ("3",)], "id string"), 0)
    assert rows(tables.read("chunks"), "doc_id") == [("2",)]
    got = rows(tables.read("embed_rejects"), "id", "reason")
    assert [r[0] for r in got] == ["1", "3"] and got[0][1] == "empty text" and got[1][1].startswith("bad vector")


def test_no_more_links_are_asked_for_than_may_wait(spark, rows, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    queue = [(f"http://h.org/{i}", "h.org", 0, T0, T0) for i in range(6)]
    tables.write("frontier", 0, spark.createDataFrame(queue, "url string, host string, depth int, created_at timestamp, updated_at timestamp"))
    sites = spark.createDataFrame([("h.org", 3, 1.0)], "host string, depth int, interval_s double")
    rules_table = spark.createDataFrame([], "host string, agent string, kind string, prefix string, section int, pos int")
    run = crawl_batch(tables, sites, rules_table, now(), per_host=2, max_waiting=4)
    for batch in range(4):
        run(responses_none(spark), batch)
    assert tables.waiting(4).count() == 4 and tables.frontier().count() == 2
    assert rows(tables.counts().filter("table = 'asked'"), "batch_id", "rows") == [(0, 2), (1, 2)]


def test_every_link_that_leaves_the_queue_is_accounted_for(spark, rows, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    queue = [("http://h.org/ok", 0), ("http://h.org/deep", 9), ("http://h.org/seen", 0), ("h.org no url", 0), ("http://h.org/no", 0)]
    links = [(u, "h.org", d, T0 + dt.timedelta(seconds=i), T0) for i, (u, d) in enumerate(queue)]
    tables.seed(spark.createDataFrame(links, "url string, host string, depth int, created_at timestamp, updated_at timestamp"))
    tables.write("visits", -1, spark.createDataFrame([("http://h.org/seen",)], "url string").withColumn("visited_at", now()))
    sites = spark.createDataFrame([("h.org", 3, 1.0)], "host string, depth int, interval_s double")
    rules_table = spark.createDataFrame([("h.org", DEFAULT_AGENT, "disallow", "/no", 0, 0)], "host string, agent string, kind string, prefix string, section int, pos int")
    crawl_batch(tables, sites, rules_table, now(), per_host=9)(responses_none(spark), 0)
    assert rows(tables.read("asked"), "url") == [("http://h.org/ok",)] and tables.frontier().count() == 0
    assert rows(tables.read("crawl_rejects"), "url", "reason") == sorted([
        ("h.org no url", "not a URL"), ("http://h.org/deep", frontier.TOO_DEEP), ("http://h.org/no", frontier.FORBIDDEN),
        ("http://h.org/seen", frontier.VISITED),
    ], key=repr)


def whole_state(tables, rows, batch):
    return [rows(d) for d in (
        tables.documents(), tables.frontier().select("url", "added"), tables.waiting(batch), tables.held(batch),
        tables.read("visits").groupBy("url").agg(F.max("visited_at").alias("at")),
    )]


def test_compacted_logs_read_the_same(spark, rows, tmp_path):
    """Links, requests, answers, visits and documents over several rounds, with snapshots in between."""
    sites = spark.createDataFrame([("h.org", 9, 1.0)], "host string, depth int, interval_s double")
    rules_table = spark.createDataFrame([], "host string, agent string, kind string, prefix string, section int, pos int")
    answer = "url string, status int, content_type string, body string"

    def crawled(home, snapshots):
        tables = StageTables(spark, str(tmp_path / home))
        links = [(f"http://h.org/{i}", "h.org", 0, T0 + dt.timedelta(seconds=i), T0) for i in range(5)]
        tables.seed(spark.createDataFrame(links, "url string, host string, depth int, created_at timestamp, updated_at timestamp"))
        crawl = crawl_batch(tables, sites, rules_table, now(), per_host=2)
        parse = parse_batch(tables, sites, now())
        for n in range(3):
            got = [(f"http://h.org/{n}", 200, "text/html", page(f"t{n}", f"/new{n}", "/1")), (f"http://h.org/{4 - n}", 200, "text/html", page(f"u{n}"))]
            crawl(spark.createDataFrame(got, answer), n)
            parse(tables.read("messages").filter(F.col("batch_id") == n).select("message"), n)
            if snapshots:
                state = whole_state(tables, rows, n + 1)
                tables.compact(n, n)
                assert whole_state(tables, rows, n + 1) == state == whole_state(StageTables(spark, tables.root), rows, n + 1)
                tables.compact(n, n)  # again: the same
                assert whole_state(tables, rows, n + 1) == state
        return tables

    plain, compacted = crawled("a", False), crawled("b", True)
    for one, other in zip(whole_state(plain, rows, 3), whole_state(compacted, rows, 3), strict=True):
        assert [r for r in one] == [r for r in other] or [r[1:] for r in one] == [r[1:] for r in other]
    assert rows(plain.read("crawl_rejects"), "url", "reason") == rows(compacted.read("crawl_rejects"), "url", "reason")
    # A trigger reads the folders since the snapshot and rows that are still needed.
    text = compacted.read("frontier")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id#\d+L? > 2", text.replace("\n", " "))
    assert compacted.read("closed").count() == compacted.read("spent").count() == 0
    assert compacted.read("asked").count() == compacted.waiting(9).count() and plain.read("asked").count() > compacted.read("asked").count()


def test_documents_keep_their_identity_over_snapshots(spark, rows, sites, tmp_path):
    tables = StageTables(spark, str(tmp_path / "t"))
    run = parse_batch(tables, sites, now())
    for batch, (text, url) in enumerate([("one", "1"), ("two", "1"), ("three", "2")]):
        run(spark.createDataFrame([(f"m{batch}", page(text), 0, f"http://h.org/{url}")], MESSAGE), batch)
    before = rows(tables.documents())
    for _ in range(2):
        tables.compact(parsed=2)
        assert rows(tables.documents()) == before and tables.read("documents").count() == 2
    run(spark.createDataFrame([("m4", page("four"), 0, "http://h.org/1")], MESSAGE), 3)
    after = {r["url"]: r for r in tables.documents().collect()}
    assert after["http://h.org/1"]["content"] == "T four" and after["http://h.org/1"]["doc_id"] in {r[0] for r in before}
