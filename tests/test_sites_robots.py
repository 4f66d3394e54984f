import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trawlspark.operators import robots, sites


def configs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, config string")


def test_last_entry_of_a_host_wins(spark, rows):
    text = json.dumps({"sites": [
        {"url": "https://a.org/x", "depth": 1, "rps": 1},
        {"url": "https://b.org/", "rps": 4},
        {"url": "https://A.org/y"},
        {"url": "mailto:x@y", "depth": 1},
    ]})
    got = sites.parse_sites(configs(spark, text), order="n")
    assert rows(got) == [("a.org", "https://a.org/y", None, None, 0.5), ("b.org", "https://b.org/", None, 4, 0.25)]
    entries = sites.site_entries(configs(spark, text))
    assert [r[0] for r in rows(sites.seed_frontier(entries))] == ["https://a.org/x", "https://a.org/y", "https://b.org/"]
    assert rows(sites.robots_targets(entries))[0] == ("a.org", "https://a.org/robots.txt")


@pytest.mark.parametrize("text", ["{}", '{"sites": null}', "no json", '{"sites": [{"url": "http://a/", "rps": 0}]}'])
def test_bad_config_is_an_error(spark, text):
    with pytest.raises(PySparkException):
        sites.parse_sites(configs(spark, text)).collect()


def test_read_sites(spark, tmp_path, rows):
    (tmp_path / "sites.json").write_text('{\n "sites": [\n {"url": "http://a/",\n "depth": 2, "rps": 2}\n]}')
    assert rows(sites.read_sites(spark, str(tmp_path / "sites.json"))) == [("a", "http://a/", 2, 2, 0.5)]


BOT = robots.DEFAULT_AGENT


def parsed(spark, body, status=200):
    return robots.parse_robots(spark.createDataFrame([("h", status, body)], "host string, status int, body string"))


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("Disallow: /a\nUser-agent: x\nAllow: /b", [("*", "disallow", "/a"), ("x", "agent", None), ("x", "allow", "/b")]),
        ("user-agent: x\n Allow: /b\nALLOW: /c\n# Disallow: /d", []),
        ("User-agent: x # c\nDisallow: /a:8/b\nDisallow:\r\n", [
            ("x # c", "agent", None), ("x # c", "disallow", "/a"), ("x # c", "disallow", "")]),
        ("User-agent:\nAllow: /", [("", "agent", None), ("", "allow", "/")]),
        ("User-agent: x\nUser-agent: y\nAllow: /", [("x", "agent", None), ("y", "agent", None), ("y", "allow", "/")]),
        ("a\rUser-agent: x\nAllow: /", [("*", "allow", "/")]),  # a lone CR ends no line
        ("", []),
    ],
)
def test_parse_robots(spark, rows, body, want):
    got = rows(parsed(spark, body), "agent", "kind", "prefix")
    assert got == sorted(want, key=repr)


def test_missing_file_has_no_rules(spark):
    assert parsed(spark, "Disallow: /", 404).count() == 0
    assert parsed(spark, "Disallow: /", 500).count() == 1


@pytest.mark.parametrize(
    ("body", "path", "want", "star", "no_empty"),
    [
        (f"User-agent: {BOT}\nDisallow: /a\nAllow: /a/b", "/a/b/c", True, True, True),
        (f"User-agent: {BOT}\nDisallow: /a", "/ab", False, False, False),
        (f"User-agent: {BOT}\nDisallow: /a", "/b", True, True, True),
        ("User-agent: *\nDisallow: /", "/b", True, False, True),  # "*" counts only as a fallback
        (f"User-agent: *\nDisallow: /\nUser-agent: {BOT}\nAllow: /x", "/b", True, True, True),
        (f"User-agent: {BOT}\nDisallow:", "/b", False, False, True),  # an empty prefix matches everything
        (f"User-agent: {BOT.lower()}\nDisallow: /", "/b", True, True, True),
        ("", "/b", True, True, True),
    ],
)
def test_robots_allowed(spark, body, path, want, star, no_empty):
    urls = spark.createDataFrame([("h", "http://h" + path)], "host string, url string")
    rules = parsed(spark, body)
    assert robots.robots_allowed(urls, rules).first()["allowed"] is want
    assert robots.robots_allowed(urls, rules, fallback_star=True).first()["allowed"] is star
    assert robots.robots_allowed(urls, rules, ignore_empty=True).first()["allowed"] is no_empty


def test_rules_map_keeps_file_order(spark):
    body = "Allow: /0\nUser-agent: x\nDisallow: /2\nDisallow: /1\nUser-agent: y\nUser-agent: x\nDisallow: /0"
    got = robots.rules_map(parsed(spark, body)).first()
    assert got["allow_rules"] == {"*": ["/0"], "x": [], "y": []}
    assert got["disallow_rules"] == {"*": [], "x": ["/2", "/1", "/0"], "y": []}


def test_many_rules_do_not_multiply_urls(spark):
    body = f"User-agent: {BOT}\n" + "".join(f"Disallow: /{i}/\n" for i in range(500))
    urls = spark.range(1000).select(F.lit("h").alias("host"), F.format_string("http://h/%d/", "id").alias("url"))
    got = robots.robots_allowed(urls, parsed(spark, body))
    assert got.count() == 1000 and got.filter("allowed").count() == 500


@pytest.mark.parametrize("options", [{}, {"fallback_star": True, "ignore_empty": True}])
def test_prefix_join_equals_the_list_of_rules(spark, rows, options):
    import random

    rng = random.Random(5)
    parts = ["", "/", "/a", "/ab", "/a/b", "/a/b/c", "/é", "/x%20y", "/long/path/of/many/parts"]
    rule = [(rng.choice("hgk"), rng.choice([robots.DEFAULT_AGENT, "*", "other"]), rng.choice(["allow", "disallow"]), rng.choice(parts), i // 3, i) for i in range(40)]
    table = spark.createDataFrame(rule, "host string, agent string, kind string, prefix string, section int, pos int")
    urls = [(n, f"http://{h}{p}{q}", h) for n, (h, p, q) in enumerate((h, p, q) for h in "hgkz" for p in parts[1:] for q in ("", "/z", "b"))]
    urls += [(900, urls[0][1], "h"), (901, None, None), (902, "http://h/a", None)]
    frame = spark.createDataFrame(urls, "url_id int, url string, host string")
    want = rows(robots.robots_allowed(frame, table, **options), "url_id", "allowed")
    assert rows(robots.robots_allowed_by_prefix(frame, table, **options), "url_id", "allowed") == want


def test_a_hundred_thousand_rules_of_one_host(spark):
    table = spark.range(100_000).select(
        F.lit("h").alias("host"), F.lit(robots.DEFAULT_AGENT).alias("agent"), F.lit("disallow").alias("kind"),
        F.concat(F.lit("/d"), F.col("id"), F.lit("/")).alias("prefix"), F.lit(0).alias("section"), F.col("id").cast("int").alias("pos"),
    )
    urls = spark.range(1_000_000).select(F.lit("h").alias("host"), F.concat(F.lit("http://h/d"), F.col("id") % 200_000, F.lit("/p")).alias("url"))
    got = robots.robots_allowed_by_prefix(urls, table).groupBy("allowed").count().collect()
    assert {r["allowed"]: r["count"] for r in got} == {True: 500_000, False: 500_000}
