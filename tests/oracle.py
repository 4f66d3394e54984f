"""Compare a query's rows with its SQL: same columns, same multiset of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    return v


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(_cell(r[k]) for k in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_names = df.columns
    got = rows_of(got_names, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(got_names) != sorted(rel.columns):
        return f"columns {sorted(got_names)} != {sorted(rel.columns)}"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; only here {list((got - want).items())[:3]}; "
            f"only SQL {list((want - got).items())[:3]}"
        )
    return None
