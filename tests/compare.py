"""Side-by-side comparison of a registered query with its SQL twin."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in data)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    """None when both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    mine = [tuple(x) for x in df.collect()]
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    theirs = res.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    a, b = rows_of(df.columns, mine), rows_of(cols, theirs)
    if a != b:
        return f"{len(mine)} vs {len(theirs)} rows; only here {list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}"
    types = dict(df.dtypes)
    want = {"BIGINT": "bigint", "INTEGER": "bigint", "HUGEINT": "?", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    bad = [(c, types[c], str(d[1])) for c, d in zip(cols, res.description) if want.get(str(d[1]), "?") != types[c]]
    return f"types {bad}" if bad else None
