"""Periodic runs, the quality network and token alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trawlspark.llm import alignment, bytenet, common, periods
from trawlspark.llm import queries as llm

SF = "/root/testdata/sf0.001"
ODD = [
    (None, None), (None, "no id but words"), (1, ""), (1, ""), (2, None), (6, " \n\t "), (7, "a b " * 40), (7, "a b " * 40),
    (8, "word " * 60_000), (9, "a▁b"), (10, "two  blanks <|endoftext|> <s> é 日本 ﬁ"), (11, "x" * 70_000),
]
CLASHING = "text_key n runs start length period collapsed b h g score label_id y upto batch docs pairs links at times pair".split()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="module")
def texts(spark):
    return [(r[0], r[1]) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]


def split(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


# --- 11 runs -------------------------------------------------------------------------------------------------------


def plain_runs(words, least=24, times=3):
    out = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(least, times * p):
                out.setdefault((start, i - start + p), p)
            i += 1
    return sorted((s, n, p) for (s, n), p in out.items())


def plain_digest(doc_id, text):
    words = split(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listed = sha("".join(f"{s},{n},{p}\n" for s, n, p in runs))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, listed,
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_cover_has_every_difference():
    found = sorted((b - a) % periods.MODULUS for a in periods.COVER for b in periods.COVER if a != b)
    assert found == list(range(1, periods.MODULUS))


def random_words(rng):
    words = ["a"] * rng.randint(0, 400) if rng.random() < 0.2 else []
    for _ in range(rng.randint(0, 10)):
        some = "abcdefgh"[: rng.randint(1, 8)]
        words += [rng.choice(some) for _ in range(rng.choice([1, 2, 3, 5, 9, 40, 70, 200]))] * rng.randint(1, 9)
        words += [str(rng.random())] * (rng.random() < 0.5)
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_plain_search(seed):
    rng = random.Random(seed)
    docs = [random_words(rng) for _ in range(12)]
    docs += docs[:2]  # copies in one batch
    words = common.Words(pa.array([" \n".join(d) for d in docs]), lower=False)
    code, symbols = words.codes()
    for least, times in ((24, 3), (2, 2), (6, 3)):
        rows = periods.runs_of(code, words.doc, words.counts, symbols, least, times).tolist()
        for i, d in enumerate(docs):
            assert [tuple(r[1:]) for r in rows if r[0] == i] == plain_runs(d, least, times)


@pytest.mark.parametrize("seed", range(3))
def test_extensions_equal_plain_comparison(seed):
    rng = random.Random(seed)
    docs = [random_words(rng) + ["end"] for _ in range(4)]
    words = common.Words(pa.array([" ".join(d) for d in docs]), lower=False)
    code, n = words.codes()
    x = np.concatenate([np.r_[code[words.first[i] : words.first[i + 1]], n + i] for i in range(4)])
    text = np.concatenate([np.full(len(d) + 1, i) for i, d in enumerate(docs)])
    own = periods.Extensions(x, text, n + 4)
    pairs = [(a, b) for _ in range(3000) for a, b in [rng.sample(range(len(x)), 2)] if text[a] == text[b]]
    i, j = (np.array(p) for p in zip(*pairs, strict=True))
    for a, b, found in zip(i.tolist(), j.tolist(), own.common(i, j).tolist(), strict=True):
        k = 0
        while x[a + k] == x[b + k]:
            k += 1
        assert k == found


def test_op11_equals_plain(spark, texts):
    got = sorted((tuple(r) for r in llm.queries()["op11_periodic_runs"](spark, SF).collect()), key=repr)
    assert got == sorted((plain_digest(*r) for r in texts), key=repr)
    assert sum(r[1] for r in got) > 50


def test_op11_odd_rows(odd):
    docs = odd.withColumn("text", periods.with_repeats(F.col("doc_id"), F.col("text")))
    got = sorted((tuple(r) for r in periods.run_digests(periods.find_runs(docs)).collect()), key=repr)
    short = [r if r[0] != 8 else (8, "word " * 60) for r in ODD]
    want = [plain_digest(*r) for r in short if r[0] != 8]
    assert [r for r in got if r[0] != 8] == sorted(want, key=repr)
    long = next(r for r in got if r[0] == 8)
    assert long[1:6] == (1, 0, 60_000, 1, 60_000_000) and long[7] == hashlib.sha256(b"word").hexdigest()
    assert periods.find_runs(odd.limit(0)).count() == 0


def test_real_outputs_of_runs(spark):
    df = spark.createDataFrame([(3, "x " + "a b c " * 9 + "y")], "doc_id long, text string")
    row = periods.find_runs(df).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 27, 3)] and row["collapsed"] == "x a b c y" and row["n_words"] == 29


# --- 12 quality network --------------------------------------------------------------------------------------------


def test_chunks_cover_every_window():
    for n in (0, 1, 7, 8, bytenet.STEP, bytenet.STEP + 7, bytenet.STEP + 8, 2000):
        text = "".join(chr(33 + i % 90) for i in range(n))
        rows, first = bytenet.chunked(["z", text])
        data, at = text.encode(), first[1]
        for k, row in enumerate(rows[at:]):
            part = data[k * bytenet.STEP : k * bytenet.STEP + bytenet.CHUNK]
            assert row.tobytes() == part.ljust(bytenet.CHUNK, b"\0")
        assert (len(rows) - at) * bytenet.STEP >= n - bytenet.WIDTH + 1


def test_peaks_and_gradients():
    net = bytenet.ByteNet(5, 3, 0)
    texts = ["some text with words. " * 60, "short", "", "ÄÖ" * 300]
    rows, first = bytenet.chunked(texts)
    peaks, at = net.peaks(rows, True)
    vectors, kernel = net.p["vectors"], net.p["kernel"]
    for c, row in enumerate(rows):
        values = np.array([vectors[row[i : i + bytenet.WIDTH]].ravel() @ kernel for i in range(bytenet.STEP)])
        assert np.allclose(values.max(axis=0) + net.p["bias"], peaks[c], atol=1e-4)
        assert np.allclose(values[at[c], np.arange(5)], values.max(axis=0), atol=1e-4)
    y, weight = np.array([1, 0, 1, 0]), np.array([1.0, 2.0, 0.5, 1.0])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        z = net.logits(rows, first)
        return float((weight * (np.log1p(np.exp(z)) - y * z)).sum())

    found = net.gradients(rows, first, y, weight)
    rng = np.random.default_rng(1)
    for name in net.p:
        for _ in range(4):
            place = tuple(int(rng.integers(s)) for s in net.p[name].shape)
            if name == "vectors":
                place = (int(rows[0, 3]), place[1])
            old = net.p[name][place]
            net.p[name][place] = old + 1e-3
            up = loss()
            net.p[name][place] = old - 1e-3
            down = loss()
            net.p[name][place] = old
            assert abs((up - down) / 2e-3 - found[name][place]) < 2e-2 * max(1, abs(found[name][place])), (name, place)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = common.table(spark, sf, "labels").filter("quality is not null")
    docs = common.table(spark, sf, "documents").join(labels.select("doc_id"), "doc_id", "left_semi")
    got = bytenet.score_quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    good, bad = ([r for r in got if r["quality"] == q] for q in (1, 0))
    assert len(good) > 500 and len(bad) > 80
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    assert sum(1 - r["predicted"] for r in bad) >= 0.85 * len(bad)
    rank = sorted(got, key=lambda r: r["score"])
    places = [i for i, r in enumerate(rank) if r["quality"] == 1]
    assert (sum(places) - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad)) > 0.995


def test_op12_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    rows = bytenet.score_quality(odd, labels, epochs=1, max_bytes=700_000).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in ODD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(empty) == 1  # null and empty texts score alike
    assert {r["score"] for r in bytenet.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert bytenet.score_quality(odd.limit(0), labels, epochs=1).count() == 0
    one = labels.withColumn("quality", F.lit(1))
    assert {r["predicted"] for r in bytenet.score_quality(odd, one).collect()} == {1}


def test_examples_are_bounded_and_held_out(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(200) for _ in range(2)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    rows, _ = bytenet.examples(docs, labels, 30, 4000, "quality", "text")
    assert Counter(r["y"] for r in rows.collect()) == {0: 20, 1: 20}  # 2,000 bytes a label
    rows, _ = bytenet.examples(docs, labels, 30, 10**6, "quality", "text")
    assert Counter(r["y"] for r in rows.collect()) == {0: 30, 1: 30}


# --- 13 alignment --------------------------------------------------------------------------------------------------


@lru_cache
def names_of_a():
    both = alignment.tokenizers(alignment.MODEL_A, alignment.MODEL_B)
    return alignment._byte_letters(), {i: t for t, i in both.a.get_vocab().items()}


def plain_tokens(both, text):
    """[(start, end, id)] of both sides, from each library's own ids and pieces; nothing where the bytes differ."""
    letters, names = names_of_a()
    want, sides = b" " + (text or "").encode(), []
    ids = both.a.encode(" " + (text or ""), add_special_tokens=False).ids, both.b.encode(text or "")
    for side, own in enumerate(ids):
        at, rows, data = 0, [], b""
        for i in own:
            piece = names[i] if side == 0 else both.b.id_to_piece(i)
            if side == 0:
                raw = bytes(letters[c] for c in piece)
            elif both.b.is_byte(i):
                raw = bytes([int(piece[3:5], 16)])
            else:
                raw = piece.replace("▁", " ").encode()
            rows.append((at, at + len(raw), i))
            at, data = at + len(raw), data + raw
        sides.append((rows, data))
    same = bool(text) and sides[0][1] == want == sides[1][1]
    return (sides[0][0], sides[1][0]) if same else ([], [])


def plain_alignment(docs):
    both = alignment.tokenizers(alignment.MODEL_A, alignment.MODEL_B)
    tokens = [(i, *plain_tokens(both, t)) for i, t in docs]
    links = []
    for _, a, b in tokens:
        own, low = [], 0
        for s, e, x in a:
            while low < len(b) and b[low][1] <= s:
                low += 1
            k = low
            while k < len(b) and b[k][0] < e:
                own.append((x, b[k][2]))
                k += 1
        links.append(own)
    total = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    out = []
    for (i, a, b), own in zip(tokens, links, strict=True):
        ends, parts, low = sorted({r[1] for r in a} & {r[1] for r in b}), [], 0
        for e in ends:
            parts.append("|".join(",".join(str(r[2]) for r in side if low <= r[0] < e) for side in (a, b)))
            low = e
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""
        best = sum(total[p] == most[p[1]] for p in own)
        out.append((i, len(a), len(b), len(ends), len(own), best, sum(total[p] for p in own), digest))
    return sorted(out, key=repr)


def test_op13_equals_plain(spark, texts):
    some = texts[:120]
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in alignment.alignment_digests(df).collect()), key=repr)
    assert got == plain_alignment(some)
    assert sum(r[5] for r in got) < sum(r[4] for r in got)


def test_op13_odd_rows_and_parts(odd):
    short = [r for r in ODD if r[0] not in (8, 11)]
    got = sorted((tuple(r) for r in alignment.alignment_digests(odd.filter("doc_id is null or doc_id not in (8, 11)")).collect()), key=repr)
    assert got == plain_alignment(short)
    assert {r[1] for r in got if r[0] in (1, 2, 9)} == {0}  # empty, null, and U+2581 that B reads as a blank
    sizes = {r["doc_id"]: (len(r["ids_a"]), r["ends_a"][-1]) for r in alignment.align_tokens(odd).filter("size(ids_a) > 0").collect()}
    assert sizes[8][0] == sizes[8][1] >= 60_000 and sizes[11][0] > 0
    assert alignment.alignment_digests(odd.limit(0)).count() == 0 and alignment.align_tokens(odd.limit(0)).count() == 0


def test_parts_encode_like_whole_texts(texts):
    both = alignment.tokenizers(alignment.MODEL_A, alignment.MODEL_B)
    rng = random.Random(13)
    signs = [" ", " ", " ", "  ", "a", "the", "é", "ü", "\u00a0", "\u0085", "\u2003", "\u3000", "日本", "▁", "'s", "'", "1", ".", "\n", "\t", "😀", "ß", "\ufeff", "<s>", "\u1680"]
    some = [t for _, t in texts[:60]] + ["".join(rng.choices(signs, k=rng.randint(1, 60))) for _ in range(3000)] + ["x" * 5000, None, ""]
    x = alignment.Aligned(both, some)
    for i, t in enumerate(some):
        a, b = plain_tokens(both, t)
        assert x.a[x.first_a[i] : x.first_a[i + 1]].tolist() == [r[2] for r in a], repr(t)
        assert x.b[x.first_b[i] : x.first_b[i + 1]].tolist() == [r[2] for r in b], repr(t)


def test_groups_of_align_tokens(spark):
    df = spark.createDataFrame([(5, "Hello tokenization, naïve approach")], "doc_id long, text string")
    row = alignment.align_tokens(df).first()
    both = alignment.tokenizers(alignment.MODEL_A, alignment.MODEL_B)
    la = lb = 0
    for ea, eb in zip(row["ends_a"], row["ends_b"], strict=True):
        left = b"".join(both.bytes_a[i] for i in row["ids_a"][la:ea])
        assert left and left == b"".join(both.bytes_b[i] for i in row["ids_b"][lb:eb])
        la, lb = ea, eb
    assert (la, lb) == (len(row["ids_a"]), len(row["ids_b"]))
