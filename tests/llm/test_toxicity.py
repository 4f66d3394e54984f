"""Toxicity against a plain version that compares every text with every example."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from trawlspark.llm import common, toxicity

SF = "/root/testdata/sf0.001"


def forms(word):
    return {word} | {word[:n] + "*" for n in (4, 5, 6, 7) if n < len(word)}


def words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def plain_space(examples):
    """Terms whose distinct contexts mark label 1."""
    seen = defaultdict(set)
    for text, y in examples:
        row = ["", *words(text), ""]
        for i in range(1, len(row) - 1):
            for form in forms(row[i]):
                seen[form].add((y, tuple(row[i - 1 : i + 2])))
    p = {t: sum(y for y, _ in c) for t, c in seen.items()}
    q = {t: len(c) - p[t] for t, c in seen.items()}
    all_p, all_q = sum(p.values()), sum(q.values())
    out = set()
    for t in seen:
        due = (p[t] + q[t]) * all_p / (all_p + all_q)
        gain = (p[t] * math.log(p[t] / due) if p[t] else 0) + (q[t] * math.log(q[t] / (p[t] + q[t] - due)) if q[t] else 0)
        if p[t] >= 5 and p[t] / all_p >= 4 * (q[t] + 1) / all_q and gain > math.log(len(seen)) + 5:
            out.add(t)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    return common.table(spark, SF, "documents"), common.table(spark, SF, "labels")


def test_scores_are_those_of_a_plain_search(tables):
    docs, labels = tables
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    y = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    examples = sorted(i for i in y if i in texts)
    space = plain_space([(texts[i], y[i]) for i in examples])
    assert space
    counts = {i: Counter(f for w in words(t) for f in forms(w) if f in space) for i, t in texts.items()}
    df = Counter(f for c in counts.values() for f in c)
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in space}

    def unit(c):
        row = {t: (1 + math.log(n)) * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(w * w for w in row.values()))
        return {t: w / norm for t, w in row.items()}

    units = {i: unit(counts[i]) for i in examples if counts[i]}
    prior = sum(y.values()) / len(y)
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    assert set(got) == set(texts)
    for i in texts:
        mine = unit(counts[i]) if counts[i] else {}
        near = sorted((-sum(w * u.get(t, 0) for t, w in mine.items()), e) for e, u in units.items())
        votes = [(1 / (1.1 - min(1, -s)), y[e]) for s, e in near if s < 0][:15]
        want = (sum(v * k for v, k in votes) + prior / 1.1) / (sum(v for v, _ in votes) + 1 / 1.1)
        ties = len(near) > 15 and math.isclose(near[14][0], near[15][0], abs_tol=1e-9) and near[14][0] < 0
        assert len(got[i]["evidence"]) == len(votes)
        assert ties or math.isclose(got[i]["score"], want, abs_tol=1e-9), i


def test_frequencies_count_all_rows(spark):
    docs = spark.createDataFrame([(1, "You idiot, idiots"), (2, "IDIOT"), (2, "IDIOT"), (3, None), (None, ""), (4, "id x2y")], "doc_id long, text string")
    space = toxicity.Space(["idiot", "idio*", "id", "absent"])
    found = {r["term"]: r["n"] for r in toxicity.document_frequencies(docs, space).collect()}
    assert found == {"": 6, "idiot": 3, "idio*": 3, "id": 1}
    assert space.count("idiots idiot Id") == {"idiot": 1, "idio*": 2, "id": 1}


def test_no_cap_on_terms(spark):
    """Four hundred words that mark label 1 all have a dimension."""
    def word(head, n):
        return head + "".join(chr(97 + int(d)) for d in f"{n:06d}"[::-1])

    marks = [word("w", i) for i in range(400)]
    rows = []
    for i in range(60):
        own = [f"{m if i % 2 else word('x', i * 500 + j)} {word('p', i * 500 + j)}" for j, m in enumerate(marks)]
        rows.append((i, " ".join(own * (1 if i % 2 else 2))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert set(marks) <= toxicity.fit(docs, labels).space.names
