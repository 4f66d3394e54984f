import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trawlspark.functions.text import STOPWORDS
from trawlspark.functions.tokens import TOKEN_PATTERN, token_array, token_count, truncate_tokens
from trawlspark.operators import chunks, snippets

SIZES = [2, 3, 4, 460, 461, 462, 511, 512, 513, 920, 921, 922, 972, 973, 1000]


def token_text(n, rng):
    """A text of n - 2 tokens with uneven blanks."""
    words = [rng.choice(["alpha", "b", "c_9", "!", "é", "x.y"[1:2]]) for _ in range(n - 2)]
    return " " * rng.randint(0, 2) + "".join(w + rng.choice([" ", "\n", "  "]) for w in words)


def spans_by_hand(text, size=512, overlap=52):
    offsets = [(0, 0)] + [m.span() for m in re.finditer(r"\w+|[^\w\s]", text, re.ASCII)] + [(0, 0)]
    n, step, out = len(offsets), size - overlap, []
    for k, start in enumerate(range(0, n, step)):
        end = min(start + step, n)
        ahead = end + overlap if end + overlap < n else end
        out.append((k, start, end, ahead, offsets[start][0], offsets[end - 2][1]))
    return out


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(5)
    texts = [(n, token_text(n, rng)) for n in SIZES]
    return spark.createDataFrame(texts, "doc_id int, content string").cache(), dict(texts)


def test_windows_and_spans(documents):
    df, texts = documents
    rows = chunks.chunk_windows(chunks.tokenize(df, "content")).collect()
    got = {(r["doc_id"], r["chunk_no"]): (r["tok_start"], r["tok_end"], r["input_end"], r["chunk_start"], r["chunk_end"]) for r in rows}
    want = {(d, k): tuple(rest) for d, t in texts.items() for k, *rest in spans_by_hand(t)}
    assert got == want
    inputs = {(r["doc_id"], r["chunk_no"]): len(r["input_tokens"]) for r in rows}
    assert [inputs[513, k] for k in range(2)] == [512, 53]
    assert [inputs[512, k] for k in range(2)] == [460, 52]
    assert [inputs[921, k] for k in range(3)] == [512, 460, 1]


def test_native_spans_equal_windows(documents):
    df, texts = documents
    rows = chunks.chunk_spans(df, "content", with_input=True).collect()
    got = {(r["doc_id"], r["chunk_no"]): (r["chunk_start"], r["chunk_end"]) for r in rows}
    assert got == {(d, w[0]): w[4:] for d, t in texts.items() for w in spans_by_hand(t)}
    tokens = re.compile(r"\w+|[^\w\s]", re.ASCII).findall
    for r in rows:
        w = spans_by_hand(texts[r["doc_id"]])[r["chunk_no"]]
        marked = ["[CLS]", *tokens(texts[r["doc_id"]]), "[SEP]"][w[1]:w[3]]
        assert tokens(r["input"]) == [t for t in marked if t not in ("[CLS]", "[SEP]")]


def test_marker_only_chunk_spans_the_whole_text(documents):
    df, texts = documents
    last = [r for r in chunks.chunk_spans(df, "content").collect() if r["doc_id"] == 461][-1]
    assert (last["chunk_no"], last["chunk_start"], last["chunk_end"]) == (1, 0, len(texts[461].rstrip()))


def test_small_windows_on_a_long_text(spark):
    rng = random.Random(7)
    text = token_text(30000, rng)
    df = spark.createDataFrame([(1, text)], "doc_id int, content string")
    got = sorted(tuple(r) for r in chunks.chunk_spans(df, "content", 60, 8).select("chunk_no", "chunk_start", "chunk_end").collect())
    assert got == [(w[0], *w[4:]) for w in spans_by_hand(text, 60, 8)]


def test_spans_begin_and_end_with_the_text(documents):
    for d, t in documents[1].items():
        spans = spans_by_hand(t)
        assert spans[0][4] == 0 and max(w[5] for w in spans) == (len(t.rstrip()) if d > 2 else 0)


def test_one_token_without_markers_is_no_document(spark):
    df = spark.createDataFrame([(1, "one"), (2, "one two"), (3, "")], "doc_id int, content string")
    rows = chunks.chunk_windows(chunks.tokenize(df, "content", add_special=False)).collect()
    assert [(r["doc_id"], r["chunk_start"], r["chunk_end"]) for r in rows] == [(2, 0, 3)]
    assert [r["doc_id"] for r in chunks.chunk_spans(df, "content").collect()] == [1, 2]


def test_own_tokenizer(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id int, content string")
    got = chunks.tokenize(df, "content", lambda t: [(c, i, i + 1) for i, c in enumerate(t)]).first()["tokens"]
    assert [(r["token"], r["start"], r["end"]) for r in got] == [
        ("[CLS]", 0, 0), ("a", 0, 1), ("b", 1, 2), ("c", 2, 3), ("[SEP]", 0, 0)]


def test_counts_and_limits(spark):
    df = spark.createDataFrame([("a b!", ), ("", )], "t string")
    assert [tuple(r) for r in df.select(token_count(F.col("t")), token_count(F.col("t"), False)).collect()] == [(5, 3), (2, 0)]
    cut = df.select(truncate_tokens(token_array(F.col("t")), 4), truncate_tokens(token_array(F.col("t")), 2, False)).first()
    assert list(cut) == [["a", "b"], ["a", "b"]]
    ok, long = chunks.check_length(df, "t", 4)
    assert ok.count() == 1 and long.first()["reason"] == "5 tokens, the model takes 4"


# --- snippets -----------------------------------------------------------------------------------------------------------


def fold(positions, window):
    """Start and end as a sequential pass over keywords sorted by gap gives them."""
    pairs, last = [], 0
    for i in positions:
        pairs.append((0 if last == 0 else i - last, i))
        last = i
    if not pairs:
        return None
    pairs.sort(key=lambda p: p[0])
    start, end = pairs[0][1], 0
    for _, i in pairs:
        if i - start > window:
            end = i
    return (start, end) if start < end else None


def closed(positions, window):
    if not positions:
        return None
    gaps = [(0 if k == 0 or positions[k - 1] == 0 else p - positions[k - 1], p) for k, p in enumerate(positions)]
    far = [g for g in gaps if g[1] > positions[0] + window]
    return (positions[0], max(far)[1]) if far else None


@given(st.sets(st.integers(0, 60), max_size=15), st.integers(1, 30))
@settings(max_examples=3000, deadline=None)
def test_closed_form_equals_fold(positions, window):
    ordered = sorted(positions)
    assert closed(ordered, window) == fold(ordered, window)


def test_snippet_ranges_equal_fold(spark):
    rng = random.Random(3)
    data = []
    for d in range(200):
        n, share = rng.choice([90, 100, 101, 150, 300]), rng.choice([0.005, 0.02, 0.1, 0.5])
        data.append((d, " ".join("key" if rng.random() < share else rng.choice(["the", "zzz"]) for _ in range(n))))
    data += [(1000, "key " * 101), (1001, "key " + "zzz " * 100), (1002, "key " + "zzz " * 100 + "key"), (1003, ""),
             (1004, "key key " + "zzz " * 99 + "key zzz zzz key")]
    df = spark.createDataFrame(data, "d int, t string").withColumn("q", F.lit("The KEY!"))
    for r in snippets.snippet_ranges(df, "t", "q").collect():
        words = dict(data)[r["d"]].split()
        want = fold([i for i, w in enumerate(words) if w == "key"], 100) if len(words) > 100 else None
        assert (r["snippet_start"], r["snippet_end"]) == (want or (None, None)), r["d"]


def test_snippet_or_unchanged_text(spark):
    long = "Intro " + "KEY " + "word " * 101 + "key End"
    df = spark.createDataFrame([(1, long, "key"), (2, "Short Key", "key"), (3, long, "nothing")], "n int, t string, q string")
    got = {r["n"]: r["summary"] for r in snippets.snippet(df, "t", "q").collect()}
    assert got == {1: "key " + "word " * 100 + "word", 2: "Short Key", 3: long}


@pytest.mark.parametrize(
    ("content", "start", "end", "want"),
    [
        ("abcdefgh", 2, 5, "cde"),
        ("abcdefgh", None, None, "ab"),  # a quarter of the bytes
        ("abcdefgh", 0, 8, "abcdefgh"),
        ("abcdefgh", 0, 9, ""),
        ("abcdefgh", 9, 9, ""),
        ("abcdefgh", 3, 1, "de"),  # end becomes 8 - 3
        ("abcdefgh", 6, 1, ""),
        ("abcdefgh", 20, 1, ""),
        ("äöü", None, None, "ä"),  # six bytes
        ("äöüß", 1, 3, "öü"),
        (None, None, None, ""),
    ],
)
def test_chunk_text(spark, content, start, end, want):
    hit = spark.createDataFrame([("u", None, content, start, end, "q")],
                                "url string, title string, content string, chunk_start long, chunk_end long, query string")
    row = snippets.summarize_hits(hit).first()
    assert (row["summary"], row["title"]) == (want, "")


def test_hits_without_url_drop_out(spark):
    hit = spark.createDataFrame([(None, "t", "c", 0, 1, "q")], "url string, title string, content string, chunk_start long, chunk_end long, query string")
    assert snippets.summarize_hits(hit).count() == 0


def test_result_cards(spark):
    df = spark.createDataFrame([("http://a/b//", "", "w " * 200), ("http://a", "T", "a  b")], "url string, title string, summary string")
    first, second = snippets.result_cards(df).collect()
    assert (first["url"], first["title"], first["summary"]) == ("http://a/b/", "http://a/b/", ("w " * 150)[:-1])
    assert (second["url"], second["title"], second["summary"]) == ("http://a", "T", "a  b")


def test_stop_words_are_no_keywords(spark):
    df = spark.createDataFrame([(" ".join(STOPWORDS) + " zzz", )], "t string").withColumn("q", F.col("t"))
    assert snippets.snippet_ranges(df, "t", "q").first()["snippet_start"] is None


def test_native_tokens_equal_a_plain_tokenizer(spark):
    rng = random.Random(3)
    texts = ["", " ", "\n\n", "a", "..", "é b_c 日本 1.5", " x " * 700, "?!" * 400] + [
        "".join(rng.choices([" ", "  ", "\n", "a", "Bc9", "_", "é", "ß", "😀", ".", "-", "\t"], k=rng.randint(1, 900))) for _ in range(60)
    ]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "id int, text string")
    got = {r["id"]: r["tokens"] for r in chunks.tokenize(df, "text").collect()}
    assert got.pop(-1) is None
    plain = re.compile(TOKEN_PATTERN, re.ASCII)
    for i, t in enumerate(texts):
        want = [("[CLS]", 0, 0), *((m.group(), *m.span()) for m in plain.finditer(t)), ("[SEP]", 0, 0)]
        assert [tuple(x) for x in got[i]] == [(n, *w) for n, w in enumerate(want)]


def test_tokens_and_windows_are_native(spark):
    df = spark.createDataFrame([(1, "some text")], "doc_id int, text string")
    text = chunks.chunk_windows(chunks.tokenize(df, "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_cost_of_a_long_text_grows_with_its_length(spark):
    def seconds(words):
        df = spark.range(1).select(F.lit(1).alias("doc_id"), F.expr(f"repeat('words, and ', {words})").alias("text"))
        start = time.perf_counter()
        n = chunks.chunk_windows(chunks.tokenize(df, "text")).agg(F.count("*"), F.sum("chunk_end")).first()[0]
        spans = chunks.chunk_spans(df, "text").agg(F.count("*"), F.sum("chunk_end")).first()[0]
        assert n == spans == -(-(3 * words + 2) // 460)
        return time.perf_counter() - start

    seconds(1000)
    short, long = seconds(20_000), seconds(200_000)
    assert long < 30 * max(short, 0.5)


def test_running_sums_of_many_numbers(spark):
    sizes = [0, 1, 3, 4, 5, 16, 17, 63, 64, 65, 1000, 60_000]
    df = spark.createDataFrame([(n,) for n in sizes], "n int").select(
        "n", F.when(F.col("n") > 0, F.sequence(F.lit(1), F.greatest("n", F.lit(1)))).otherwise(F.array().cast("array<int>")).alias("x")
    ).unionByName(spark.range(1).select(F.lit(-1).alias("n"), F.lit(None).cast("array<int>").alias("x")))
    got = {r["n"]: r["s"] for r in df.select("n", chunks.running_sums(F.col("x")).alias("s")).collect()}
    assert got.pop(-1) is None
    assert got == {n: [k * (k + 1) // 2 for k in range(n + 1)] for n in sizes}


def test_tokens_are_found_in_one_pass(spark):
    df = spark.createDataFrame([(1, "some text")], "doc_id int, text string")
    text = chunks.tokenize(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") == 1  # before: one for runs of tokens and two more inside each run
