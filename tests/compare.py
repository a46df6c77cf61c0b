"""Run a query on Spark and its SQL on DuckDB and compare as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0  # both sides are rounded by the queries; no slack beyond that
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    cols = sorted(spark_df.columns)
    if cols != sorted(names):
        return f"columns {cols} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    simple = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    bad = [f"{n}: {t} / {types[n]}" for n, t in spark_df.dtypes if t in simple and simple[t] != types[n]]
    pos = [names.index(c) for c in cols]
    arrow = spark_df.toArrow()
    got = Counter(zip(*[map(norm, arrow.column(c).to_pylist()) for c in cols]))
    want = Counter(tuple(norm(r[i]) for i in pos) for r in want_rows)
    if got != want:
        a, b = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} rows vs {sum(want.values())}; {cols}; only spark {a}; only sql {b}"
    if bad:
        return "types differ: " + ", ".join(bad)
    if not got:
        return "EMPTY"
    return None
