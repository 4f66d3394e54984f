"""Licence scan by sparse TF-IDF cosine and directory inheritance (operator 10); DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .lines import row_key, split_lines

# Short notices of common licences, several wordings each.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http www.apache.org licenses"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "The MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This program is free software under the terms of the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3 Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY NC 4.0"),
    ("CC0-1.0", "Released under CC0 1.0 Universal Public Domain Dedication"),
]
# Words too common to point at a licence; they have no dimension.
COMMON = "a and any are by in is of or the this to under use with without".split()
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice)(\.(txt|md))?$"


def template_terms(spark: SparkSession) -> DataFrame:
    """(template, license, term, tf) of the fixed templates: a few hundred rows."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template int, license string, text string")
    each = rows.select("template", "license", F.explode(_terms(F.col("text"))).alias("term"))
    return each.groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))


def _terms(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)
    return F.filter(found, lambda t: ~t.isin(COMMON))


def telling_words() -> list[str]:
    import re

    words = {w for _, text in TEMPLATES for w in re.findall(TERM, text.lower())}
    return sorted(w for w in words if w not in COMMON and not w[0].isdigit())


def telling_pattern() -> str:
    """A line is looked at if it has one of the templates' words, common words and numbers aside."""
    return r"(?i)\b(?:" + "|".join(telling_words()) + r")\b"


def scan_licenses(docs: DataFrame, threshold: float = 0.6, path: str = "path", text: str = "text") -> DataFrame:
    """(doc_id, path, license, score, found_in, license_dir, lines) of every row.

    Every line with a telling word, and the whole text of every licence file (LICENSE, COPYING or NOTICE), is compared
    with the templates by TF-IDF cosine: (1 + ln tf) x (1 + ln((1 + documents) / (1 + documents with the term))), over
    all documents; words of no template weigh as if every document had them. The best template at ``threshold`` or more
    is the document's licence (``found_in`` is ``own``; ties go to the first template); ``lines`` counts its licence
    lines. A document without one takes the licence of the licence file in its nearest ancestor directory
    (``inherited``, and ``license_dir`` names the directory); else licence, score and directory are null and
    ``found_in`` is ``none``. Several licence files of one directory: the greatest score, then the first name.

    Null and empty texts have no line and may inherit. A null path has no directory. Repeated rows are decided alike
    and come out once each. Other columns are not read. Only candidate lines are exploded and shuffled; the joins with
    templates broadcast a table of fixed size, those with directories may be split by adaptive execution.
    """
    spark = docs.sparkSession
    key = row_key(docs, text)
    base = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        docs[path].cast("string").alias("path"),
        F.xxhash64(key, docs[path].cast("string")).alias("row_key"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    )
    is_file = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    chosen = F.filter(split_lines(F.col("text")), lambda x: x.rlike(telling_pattern()))
    parts = F.when(is_file & (F.size(chosen) > 0), F.concat(chosen, F.array("text"))).otherwise(chosen)
    found = F.transform(parts, _terms)
    rows = stored(base.select("doc_id", "path", "row_key", is_file.alias("is_file"), found.alias("parts")), "license-lines")

    parts = rows.filter(F.size("parts") > 0).dropDuplicates(["row_key"])
    each = parts.select("row_key", F.posexplode("parts").alias("part", "terms"))
    counts = each.select("row_key", "part", F.explode("terms").alias("term")).groupBy("row_key", "part", "term").agg(
        F.count(F.lit(1)).alias("n")
    )
    templates = template_terms(spark)
    vocabulary = templates.select("term").distinct()
    known = counts.join(F.broadcast(vocabulary), "term").select("row_key", "term").distinct()
    n_docs = rows.agg(F.count(F.lit(1)).alias("docs"))
    df = known.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # As many rows as the templates have terms.
    idf = stored(
        vocabulary.join(df, "term", "left").withColumn("docs", F.lit(n_docs.first()[0])).select(
            "term", (1 + F.log((1 + F.col("docs")) / (1 + F.coalesce("df", F.lit(0))))).alias("idf")
        ),
        "license-idf",
    )
    weight = (1 + F.log("tf")) * F.col("idf")
    weighed = templates.join(F.broadcast(idf), "term").select("template", "license", "term", weight.alias("t_weight"))
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("t_weight") * F.col("t_weight"))).alias("t_norm"))
    unit = weighed.join(F.broadcast(norms), "template").select("template", "license", "term", (F.col("t_weight") / F.col("t_norm")).alias("t_weight"))

    own_weight = (1 + F.log("n")) * F.coalesce("idf", F.lit(1.0))
    terms = counts.join(F.broadcast(idf), "term", "left").select("row_key", "part", "term", own_weight.alias("w"))
    lengths = terms.groupBy("row_key", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = terms.join(F.broadcast(unit), "term").groupBy("row_key", "part", "template", "license").agg(
        F.sum(F.col("w") * F.col("t_weight")).alias("dot")
    )
    cosines = dots.join(lengths, ["row_key", "part"]).select(
        "row_key", "part", "template", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score")
    ).filter(F.col("score") >= threshold)
    best = F.min(F.struct((-F.col("score")).alias("s"), "template", "license")).alias("b")
    own = stored(
        cosines.groupBy("row_key").agg(best, F.count_distinct("part").alias("lines")).select(
            F.col("row_key"), F.col("b.license").alias("own"), (-F.col("b.s")).alias("own_score"), "lines"
        ),
        "license-own",
    )

    marked = rows.drop("parts").join(own, "row_key", "left")
    directory = F.regexp_replace("path", "[^/]*$", "")
    files = marked.filter(F.col("is_file") & F.col("own").isNotNull()).groupBy(directory.alias("dir")).agg(
        F.min(F.struct((-F.col("own_score")).alias("s"), F.col("path"), F.col("own"))).alias("f")
    )
    dirs = files.select("dir", F.col("f.own").alias("dir_license"), (-F.col("f.s")).alias("dir_score"))
    # All ancestor directories of a path: its beginnings that end in a slash, and the empty one.
    steps = F.split("path", "/")
    ups = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/"))),
    )
    bare = marked.filter(F.col("own").isNull() & F.col("path").isNotNull()).select("path").distinct()
    above = bare.select("path", F.explode(ups).alias("dir")).join(dirs, "dir")
    nearest = F.max(F.struct(F.length("dir").alias("n"), "dir", "dir_license", "dir_score")).alias("d")
    inherited = above.groupBy("path").agg(nearest).select("path", "d.dir", "d.dir_license", "d.dir_score")
    mine = F.col("own").isNotNull()
    return marked.join(inherited, "path", "left").select(
        "doc_id",
        "path",
        F.coalesce("own", "dir_license").alias("license"),
        F.round(F.coalesce("own_score", "dir_score"), 6).alias("score"),
        F.when(mine, "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("found_in"),
        F.when(~mine, F.col("dir")).alias("license_dir"),
        F.coalesce("lines", F.lit(0)).alias("lines"),
    )


def fixture_path() -> Column:
    """Paths for the table ``documents``, which has none: two levels of directories by id.

    Every fiftieth document is the licence file of its directory, every thousandth that of the directory above.
    """
    return F.expr(
        "concat('/', doc_id div 1000, '/', CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE' "
        "WHEN doc_id % 50 = 0 THEN concat(doc_id div 50, '/LICENSE') ELSE concat(doc_id div 50, '/', doc_id, '.txt') END)"
    )


def _sql() -> str:
    values = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
    common = ", ".join(f"'{w}'" for w in COMMON)
    words = "|".join(telling_words())
    terms = f"list_filter(regexp_extract_all(lower({{}}), '{TERM}'), lambda x: x NOT IN ({common}))"
    return rf"""
WITH p(template, license, text) AS (VALUES {values}),
tt AS (SELECT template, license, unnest({terms.format("text")}) AS term FROM p),
tc AS (SELECT template, license, term, count(*) AS tf FROM tt GROUP BY ALL),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    '/' || (doc_id // 1000) || '/' || CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE' WHEN doc_id % 50 = 0 THEN (doc_id // 50) || '/LICENSE'
        ELSE (doc_id // 50) || '/' || doc_id || '.txt' END AS path FROM documents),
s AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(?i)\b(?:{words})\b')) AS found FROM d),
e AS (SELECT rid, unnest(CASE WHEN doc_id % 50 = 0 AND len(found) > 0 THEN list_append(found, text) ELSE found END) AS part,
    generate_subscripts(CASE WHEN doc_id % 50 = 0 AND len(found) > 0 THEN list_append(found, text) ELSE found END, 1) AS no FROM s),
w AS (SELECT rid, no, unnest({terms.format("part")}) AS term FROM e),
c AS (SELECT rid, no, term, count(*) AS n FROM w GROUP BY ALL),
df AS (SELECT term, count(DISTINCT rid) AS df FROM c GROUP BY term),
i AS (SELECT term, 1 + ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(df, 0))::DOUBLE) AS idf FROM (SELECT DISTINCT term FROM tc) LEFT JOIN df USING (term)),
tw AS (SELECT template, license, term, (1 + ln(tf)) * idf AS tw FROM tc JOIN i USING (term)),
tn AS (SELECT template, sqrt(sum(tw * tw)) AS tn FROM tw GROUP BY template),
x AS (SELECT rid, no, c.term, (1 + ln(n)) * coalesce(idf, 1) AS w FROM c LEFT JOIN i ON c.term = i.term),
nn AS (SELECT rid, no, sqrt(sum(w * w)) AS norm FROM x GROUP BY ALL),
q AS (SELECT rid, no, template, license, sum(w * tw / tn) AS dot FROM x JOIN tw USING (term) JOIN tn USING (template) GROUP BY ALL),
z AS (SELECT rid, no, template, license, round(dot / norm, 9) AS score FROM q JOIN nn USING (rid, no) WHERE round(dot / norm, 9) >= 0.6),
o AS (SELECT rid, license AS own, score AS own_score FROM z QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, template) = 1),
m AS (SELECT d.*, own, own_score FROM d LEFT JOIN o USING (rid)),
f AS (SELECT regexp_replace(path, '[^/]*$', '') AS dir, own, own_score FROM m WHERE own IS NOT NULL AND doc_id % 50 = 0
    QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '[^/]*$', '') ORDER BY own_score DESC, path, own) = 1),
h AS (SELECT rid, dir, f.own AS dir_license, f.own_score AS dir_score FROM m JOIN f ON starts_with(m.path, f.dir)
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(dir) DESC) = 1)
SELECT doc_id, path, coalesce(own, dir_license) AS license, round(coalesce(own_score, dir_score), 6) AS score,
    CASE WHEN own IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS found_in,
    CASE WHEN own IS NULL THEN dir END AS license_dir
FROM m LEFT JOIN h USING (rid)
"""


SQL = _sql()
