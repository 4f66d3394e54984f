"""Cases in which an operator once did less than the whole job."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_methods import story, union_find

from trawlspark.llm import decontaminate, html, mixing, passages, quality


# --- 2 passages ----------------------------------------------------------------------------------------------------


def test_parts_of_a_failing_chain(spark):
    rng = random.Random(12)
    one, two, whole = story(rng, 55), story(rng, 55), story(rng, 104)
    rows = [
        (1, story(rng, 30) + one + story(rng, 60) + two + story(rng, 30)),  # two passages, 60 other words between
        (2, story(rng, 45) + one + story(rng, 60) + two + story(rng, 20)),
        (3, story(rng, 40) + whole + story(rng, 40)),
        (4, story(rng, 25) + whole[:52] + story(rng, 60) + whole[52:] + story(rng, 40)),  # an insert
        (5, story(rng, 40) + whole[:45] + story(rng, 60)),  # too short to count
    ]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted(tuple(r) for r in passages.shared_passages(df).collect())
    assert got == [
        (2, 1, "passage", 45, 100, 30, 85, 55, 55),
        (2, 1, "passage", 160, 215, 145, 200, 55, 55),
        (4, 3, "passage", 25, 77, 40, 92, 52, 52),
        (4, 3, "passage", 137, 189, 92, 144, 52, 52),
    ]


def holds_passage(x, y, least=50, identity=0.8):
    """Plain check of two rows of the same length whose words were only replaced."""
    same = [a == b for a, b in zip(x, y, strict=True)]
    sums = [0]
    for s in same:
        sums.append(sums[-1] + s)
    n = len(same)
    return any(sums[j] - sums[i] >= identity * (j - i) for i in range(n) for j in range(i + least, n + 1))


def replaced(rng, words, rate):
    return [story(rng, 1)[0] + "x" if rng.random() < rate else w for w in words]


@pytest.mark.parametrize(("n", "rate", "share"), [(60, 0.05, 0.98), (60, 0.1, 0.93), (60, 0.15, 0.85), (100, 0.15, 0.95)])
def test_pairs_with_replaced_words_as_by_brute_force(spark, n, rate, share):
    rng, rows, want = random.Random(n), [], set()
    for i in range(0, 300, 2):
        one = story(rng, n)
        two = replaced(rng, one, rate)
        rows += [(i, " ".join(story(rng, 80) + one + story(rng, 80))), (i + 1, " ".join(story(rng, 70) + two + story(rng, 90)))]
        want |= {(i + 1, i)} if holds_passage(one, two) else set()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["other_id"]) for r in passages.shared_passages(df).collect()}
    assert got <= {(i + 1, i) for i in range(0, 300, 2)} and len(want) > 120
    assert len(got & want) >= share * len(want)


def test_a_group_with_replaced_words_hangs_together(spark):
    rng = random.Random(21)
    one = story(rng, 80)
    copies = [replaced(rng, one, 0.05) for _ in range(150)]
    find = union_find(150, [(i, j) for i in range(150) for j in range(i) if holds_passage(copies[i], copies[j])])
    df = spark.createDataFrame([(i, " ".join(story(rng, 50) + c + story(rng, 40))) for i, c in enumerate(copies)], "doc_id long, text string")
    links = passages.shared_passages(df).collect()
    found = union_find(150, [(r["doc_id"], r["other_id"]) for r in links])
    assert len({find(i) for i in range(150)}) == len({found(i) for i in range(150)}) == 1
    assert len({(r["doc_id"], r["other_id"]) for r in links}) < 150 * 149 / 8  # far from all pairs


def test_links_from_either_side(spark):
    rng = random.Random(3)
    one = story(rng, 70)
    rows = [(i, " ".join(story(rng, 10 * i) + one + story(rng, 30))) for i in (1, 2, 3)] + [(4, " ".join(story(rng, 90)))]
    links = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    both = passages.from_either_side(links)
    assert both.columns == links.columns and both.count() == 2 * links.count()
    assert {(r["doc_id"], r["start"], r["end"]) for r in both.collect()} == {(i, 10 * i, 10 * i + 70) for i in (1, 2, 3)}


def test_words_in_common_bound_the_matches():
    rows = [[1, 2, 3, 3], [], [-1, 5], [7]], [[3, 2], [1], [5, -1, -1], []]
    x, y = (pa.array(r, pa.list_(pa.int32())) for r in rows)
    assert passages.common_words(x, y).tolist() == [3, 0, 2, 0]
    assert passages.common_words(x.slice(2), y.slice(2)).tolist() == [2, 0]


# --- 1 mixing ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_a_long_document_leaves_no_gap(spark, seed):
    rows = [(0, "a", "w " * 20_000)] + [(i, "a", "w " * 20) for i in range(1, 1001)]
    rows += [(2000 + i, "b", "w " * 10) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_sources(df, seed=seed, shards=4).groupBy("source").agg(F.sum("taken"), F.max("target")).collect()
    assert all(abs(taken - target) <= 10 for _, taken, target in got)
    assert mixing.fill([20_000, 20, 0, 30, 20], 50) == [False, True, False, True, False]


# --- 7 pages -------------------------------------------------------------------------------------------------------

LONG = "A sentence of the article that goes on for quite some while, so that its density is high enough to be found. " * 3
PARA = f"<p>{LONG}</p>"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-comments", "social-science", "contentWithSidebar", "widget", "notice-text"])
def test_names_of_wrappers_do_not_empty_a_page(name):
    for tag in ("div", "main", "article"):
        page = f'<body><div class="left-sidebar"><p>side</p></div><{tag} class="{name}" id="{name}">{PARA}<div class="cookieNotice">c</div></{tag}></body>'
        assert html.extract_text(page) == LONG.strip()
    noise = ("sidebar", "site-footer", "comment-list", "related-posts", "adBox")
    page = "<body>" + PARA + "".join(f'<div class="{n}">other words</div>' for n in noise) + "</body>"
    assert html.extract_text(page) == LONG.strip()
    page = f'<body><div class="post">{PARA}</div><div id="comments">{PARA.replace("article", "post") * 9}</div></body>'
    assert html.extract_text(page) == LONG.strip()  # comments are none, however long


def test_all_of_the_article_is_kept():
    links = "".join(f'<li><a href="{i}">source number {i}</a></li>' for i in range(4))
    got = html.extract_text(f"<body><article>{PARA}<ul>{links}</ul></article></body>")
    assert got.split("\n") == [LONG.strip(), *(f"source number {i}" for i in range(4))]
    page = f"<body><div>{PARA * 3}</div><div>{LONG}</div><table><tr><td>{LONG}</td></tr></table><div><a href='x'>more</a></div></body>"
    assert html.extract_text(page).split("\n") == [LONG.strip()] * 5


@pytest.mark.parametrize("tag", ['form id="aspnetForm"', 'div role="form"', 'form class="page"'])
def test_a_form_around_the_page_does_not_empty_it(tag):
    name = tag.split()[0]
    page = f'<body><{tag}><div id="content">{PARA}<input name="q"><select><option>one</option></select></div></{name}></body>'
    assert html.extract_text(page) == (LONG.strip() if name == "form" else "")
    page = f"<body><article>{PARA}</article><form><label>Your name</label><p>Send us a word</p></form></body>"
    assert html.extract_text(page) == LONG.strip()


# --- 9 benchmark ---------------------------------------------------------------------------------------------------


def test_short_items_and_items_without_id(spark):
    long = "a passage of some length that stands in the benchmark without any id and has ninety bytes or so"
    items = [(None, long), (1, "What is the capital of Burkina Faso?"), (2, "yes"), (3, "is the"), (4, "你好吗世界你好吗"), (5, "cat sat on"), (None, None)]
    docs = [
        (10, f"before it {long} and after it"), (11, "Quiz: what is the capital of Burkina-Faso, then?"), (12, "yes it is the one"),
        (13, "前你好吗世界你好吗后 x"), (14, "x 你好吗世界你好吗 y"), (15, "the concat sat on"), (16, "the cat sat, on it"), (17, "what is the capital of Burkina Fasos"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.find_passages(df, bench).collect()), key=repr)
    assert got == [(10, None, 0), (11, 1, 0), (14, 4, 0), (16, 5, 0)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()) == [12, 13, 15, 17]


# --- 4 quality -----------------------------------------------------------------------------------------------------


def test_equal_rows_of_two_hosts_lose_their_own_lines_only(spark):
    line = "all rights reserved by the people of this site"
    text = " ".join(f"w{i}" for i in range(18)) + "\n" + line
    rows = [(i, "a", f"text number {i} with words\n{line}") for i in range(30)] + [(i, "b", f"other number {i} with words") for i in range(100, 130)]
    rows += [(500, "a", text), (500, "b", text), (501, None, text), (501, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {(r["doc_id"], r["n_words"], r["n_left_words"]) for r in quality.quality_rules(df).collect() if r["doc_id"] >= 500}
    assert got == {(500, 27, 18), (500, 27, 27), (501, 27, 27), (501, 0, 0)}
