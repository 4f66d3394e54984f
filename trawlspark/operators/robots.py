"""Robots rules as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import url_path

# Fixed value: the agent name rules are looked up for, unless the caller names another.
DEFAULT_AGENT = "Corpus Search"

_AGENT, _ALLOW, _DISALLOW = "User-agent:", "Allow:", "Disallow:"


def _value(line: Column) -> Column:
    """Text between the first and second colon, trimmed."""
    return F.regexp_replace(F.split_part(line, F.lit(":"), F.lit(2)), r"(?U)^\s+|\s+$", "")


def parse_robots(texts: DataFrame) -> DataFrame:
    """(host, status, body) → (host, agent, kind, prefix, section, pos); kind is agent, allow or disallow.

    A text is cut into sections that begin with an agent line, so every rule finds its agent in its own section
    and no window over the lines is needed. Rules ahead of any agent line belong to "*". Line starts are matched
    exactly as written above: case and leading blanks matter. A 404 answer is an empty text.
    """
    body = F.when(F.col("status") == 404, F.lit("")).otherwise(F.col("body"))
    sections = texts.select("host", F.posexplode(F.split(body, r"(?md)^(?=User-agent:)")).alias("section", "text"))
    lines = sections.select("host", "section", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line"), "text")
    line = F.col("line")
    kind = (
        F.when(line.startswith(_AGENT), "agent")
        .when(line.startswith(_ALLOW), "allow")
        .when(line.startswith(_DISALLOW), "disallow")
    )
    owner = F.when(F.col("text").startswith(_AGENT), _value(F.split_part("text", F.lit("\n"), F.lit(1)))).otherwise("*")
    return (
        lines.select("host", owner.alias("agent"), kind.alias("kind"), _value(line).alias("prefix"), "section", "pos")
        .filter(F.col("kind").isNotNull())
        .withColumn("prefix", F.when(F.col("kind") != "agent", F.col("prefix")))
    )


def rules_per_agent(rules: DataFrame) -> DataFrame:
    """(host, agent, allow, disallow): prefix lists in file order."""
    listed = F.array_sort(F.collect_list(F.when(F.col("kind") != "agent", F.struct("section", "pos", "kind", "prefix"))))
    grouped = rules.groupBy("host", "agent").agg(listed.alias("_rules"))

    def pick(kind: str) -> Column:
        return F.filter(F.col("_rules"), lambda r: r["kind"] == kind).getField("prefix")

    return grouped.select("host", "agent", pick("allow").alias("allow"), pick("disallow").alias("disallow"))


def rules_map(rules: DataFrame) -> DataFrame:
    """(host, allow_rules, disallow_rules): maps from agent to prefix list."""
    per_agent = rules_per_agent(rules)

    def as_map(name: str) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(F.struct("agent", name))))

    return per_agent.groupBy("host").agg(as_map("allow").alias("allow_rules"), as_map("disallow").alias("disallow_rules"))


def host_rules(rules: DataFrame, agent: str, fallback_star: bool = False, ignore_empty: bool = False) -> DataFrame:
    """(host, allow, disallow) for one agent: one row per host, so that joining it multiplies no URLs."""
    wanted = rules.filter(F.col("agent").isin(agent, "*") if fallback_star else F.col("agent") == agent)
    table = rules_per_agent(wanted)
    if fallback_star:
        own = F.col("agent") == agent
        table = table.groupBy("host").agg(
            F.max_by(F.struct("allow", "disallow"), own).alias("_r")
        ).select("host", "_r.*")
    else:
        table = table.drop("agent")
    if ignore_empty:
        table = table.withColumn("disallow", F.filter("disallow", lambda p: p != ""))
    return table


def path_allowed(path: Column, allow: Column, disallow: Column) -> Column:
    """An allow prefix decides first, then a disallow prefix; no rule means yes. Empty prefixes match all paths."""
    hit = lambda rules: F.coalesce(F.exists(rules, lambda p: path.startswith(p)), F.lit(False))
    return hit(allow) | ~hit(disallow)


def robots_allowed(
    urls: DataFrame,
    rules: DataFrame,
    agent: str = DEFAULT_AGENT,
    fallback_star: bool = False,
    ignore_empty: bool = False,
    out: str = "allowed",
) -> DataFrame:
    """Adds whether the agent may fetch each URL (needs url and host).

    The join key is the host only and the rules side has one row per host: a hash or merge join without fan-out.
    """
    table = host_rules(rules, agent, fallback_star, ignore_empty)
    return (
        urls.join(table, "host", "left")
        .withColumn(out, path_allowed(url_path("url"), F.col("allow"), F.col("disallow")))
        .drop("allow", "disallow")
    )


def robots_allowed_by_prefix(
    urls: DataFrame,
    rules: DataFrame,
    agent: str = DEFAULT_AGENT,
    fallback_star: bool = False,
    ignore_empty: bool = False,
    out: str = "allowed",
) -> DataFrame:
    """``robots_allowed`` for hosts with very many rules: no path is held against a list of rules.

    A path is cut at the lengths that the rules of its host have (one array per host, as long as there are different
    lengths), and the pieces are joined to the rules by equality. Each different path of a host is looked up once; the
    answers are combined before their shuffle and joined back by host and path.
    """
    listed = host_rules(rules, agent, fallback_star, ignore_empty)
    kinds = [listed.select("host", F.explode_outer(k).alias("prefix"), F.lit(k == "allow").alias("allow")) for k in ("allow", "disallow")]
    known = kinds[0].unionAll(kinds[1]).filter(F.col("prefix").isNotNull())
    table = known.groupBy("host", "prefix").agg(F.max("allow").alias("allow"))  # an allow decides over an equal disallow
    lengths = table.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    rows = urls.withColumn("_path", url_path("url"))
    pieces = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    paths = rows.select("host", F.col("_path").alias("path")).distinct().join(lengths, "host")
    cut = paths.select("host", "path", F.explode(pieces).alias("prefix"))
    hits = cut.join(table, ["host", "prefix"]).groupBy("host", "path").agg(F.max("allow").alias("_allow"))
    found = hits.withColumnRenamed("path", "_path")
    # No rule that fits means yes; else it takes an allow among those that fit.
    return rows.join(found, ["host", "_path"], "left").withColumn(out, F.coalesce("_allow", F.lit(True))).drop("_path", "_allow").select(*urls.columns, out)
