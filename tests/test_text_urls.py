import pytest
from pyspark.sql import functions as F

from trawlspark.functions import text as tx
from trawlspark.functions import urls
from trawlspark.functions.htmltext import page_parts
from trawlspark.functions.weburl import absolute_url, page_links


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f("v")).first()[0]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("a[b\rc]d", "ad"),
        ("a[x\ny]b", "a[xy]b"),  # "." stops at a line feed; the line feed itself goes
        ("a[x y]b", "ab"),
        ("a[]b[c]d", "abd"),
        ("a   b", "a   b"),
        ("a    b", "ab"),
        ("a     b", "a b"),
        ("a        b", "ab"),
        ("a\nb\tc\rd", "abcd"),
        ("x<b>y</b>z", "xyz"),
        ("x<b y", "x<b y"),
        ("x<b\ny>z", "xz"),
        ("naïve café", "nave caf"),
    ],
)
def test_clean_text(spark, given, want):
    assert one(spark, given, tx.clean_text) == want


def test_snippet_text_keeps_tags_and_lowers(spark):
    assert one(spark, "A<B>\n[q]C", tx.clean_snippet_text) == "a<b>c"


def test_words_have_no_empty_strings(spark):
    assert one(spark, "  a  b\x0bc ", tx.words) == ["a", "b", "c"]
    assert one(spark, "   ", tx.words) == []


def test_stop_words(spark):
    assert len(tx.STOPWORDS) == len(set(tx.STOPWORDS)) == 179
    df = spark.createDataFrame([(["The", "cat,", "isn't", "the,"],)], "w array<string>")
    assert df.select(tx.remove_stopwords(F.col("w"))).first()[0] == ["cat,", "the,"]


def test_keyword_is_a_substring_of_the_query(spark):
    df = spark.createDataFrame([("ink",), ("pink",), ("the",), ("inks",)], "w string")
    got = df.select("w", tx.is_keyword(F.col("w"), F.lit("the pink floyd"))).collect()
    assert dict(tuple(r) for r in got) == {"ink": True, "pink": True, "the": False, "inks": False}


@pytest.mark.parametrize(
    ("url", "host", "path", "valid"),
    [
        ("http://E.Org", "e.org", "/", True),
        ("https://u:p@a.b_c:8080/x y?q#f", "a.b_c", "/x y", True),
        ("http://bücher.de/ä", "bücher.de", "/ä", True),
        ("http://[::1]:80/x", "[::1]", "/x", True),
        ("http://h?q=/a", "h", "/", True),
        ("http:///x", None, "/x", False),
        ("mailto:a@b", None, "/", True),
        ("/rel", None, "/", False),
        ("http://[", None, "/", False),
        ("", None, "/", False),
    ],
)
def test_url_parts(spark, url, host, path, valid):
    assert one(spark, url, urls.url_host) == host
    assert one(spark, url, urls.is_valid_url) is valid
    assert one(spark, url, urls.url_path) == path


def test_robots_url_and_param(spark):
    assert one(spark, "HTTPS://A.b/x", urls.robots_url) == "https://a.b/robots.txt"
    assert one(spark, "ftp://a.b/x", urls.robots_url) is None
    assert one(spark, "a b\tc  d", urls.query_to_param) == "a+b+c++d"


BASE = "http://H.org:80/d/e?q#f"


@pytest.mark.parametrize(
    ("href", "want"),
    [
        ("#x", []),
        ("/a", ["http://h.org/a"]),
        ("a/b", ["http://h.org/d/a/b"]),
        ("../c", ["http://h.org/c"]),
        ("../../../c", ["http://h.org/c"]),
        ("./", ["http://h.org/d/"]),
        ("//X/p", ["http://x/p"]),
        ("?z=1", ["http://h.org/d/e?z=1"]),
        ("", ["http://h.org/d/e?q"]),
        ("page#x", ["http://h.org/d/page#x"]),
        ("http://H:80/x", ["http://h/x"]),
        ("https://h:80/%7Ea b", ["https://h:80/%7Ea%20b"]),
        ("http:\\\\h\\x", ["http://h/x"]),
        ("httpfoo", []),  # relative, but begins with "http"
        ("mailto:a@b", ["mailto:a@b"]),
        ("javascript:void(0)", ["javascript:void(0)"]),
        ("http://[", []),
        ("http://a b/", []),
        ("http://h:99999/", []),
        ("/für?ü#ü", ["http://h.org/f%C3%BCr?%C3%BC#%C3%BC"]),
        ("  /a\n", ["http://h.org/a"]),
        ("http://bücher.de", ["http://xn--bcher-kva.de/"]),
        ("http://0x7f.1/", ["http://127.0.0.1/"]),
        ("/a/%2e%2E/b/.", ["http://h.org/b/"]),
        ("/a:b", ["http://h.org/a:b"]),
    ],
)
def test_page_links(href, want):
    assert page_links(BASE, [href]) == want


def test_links_keep_order_and_duplicates():
    assert page_links("http://h/", ["/b", "/a", "#", "/b"]) == ["http://h/b", "http://h/a", "http://h/b"]


def test_absolute_url_without_base():
    assert absolute_url("/a") is None
    assert absolute_url("HTTP://A/..") == "http://a/"


@pytest.mark.parametrize(
    ("html", "title", "body", "hrefs"),
    [
        ("", "", "", []),
        ("<html><head><title>T</title></head><body></body></html>", "T", "", []),
        ("<title>A &amp; <b>B</title><body>x", "A & <b>B", "x", []),
        ("<body>a<b>c</b>d</body>", "", "a c d", []),
        ("<body>a<!-- x > y -->b", "", "a b", []),
        ("<body>a<script>var t='</p><a href=q>';</script>b<style>x</style>c", "", "a b c", []),
        ("hello <i>w</i>", "", "hello  w", []),
        ("<body> \n </body>", "", " \n ", []),
        ("<p>a</p>\n</body>\n</html>\n", "", "a \n\n\n", []),  # text after the body joins it
        ("<body>a</div>b", "", "ab", []),  # a stray end tag is nothing
        ("<body>x &copy; &lt;b&gt; &amp y &am", "", "x © <b> & y &am", []),
        ("<body>cut <a href='/x' cla", "", "cut ", []),
        ("<body>1 < 2 <3", "", "1 < 2 <3", []),
        ('<a href=/a>1</a><A HREF = "/b" href="/c">2</A><a name=x>3</a><a href=\'/d?x=1&amp;y\'>', "", "1 2 3",
         ["/a", "/b", "/d?x=1&y"]),
        ("<a title='a > b' href=\"x\">t</a>", "", "t", ["x"]),
        ("<svg><title>S</title></svg><title>T</title>", "S", "S T", []),
        ("<body><textarea>\n<b>raw</b></textarea><pre>\nx</pre>", "", "<b>raw</b> x", []),
        ("<head><noscript><a href=/n>n</a></noscript></head><body>b", "", "b", []),
        ("<script>unclosed <body>x", "", "", []),
    ],
)
def test_page_parts(html, title, body, hrefs):
    assert page_parts(html) == (title, body, hrefs)


def test_page_parts_is_linear_on_hostile_input():
    for bad in ("<" * 200000, "<a " + "x=" * 100000, "<a href='" + "b " * 100000, "<!--" * 50000, "<p " + "/" * 200000):
        page_parts(bad)
