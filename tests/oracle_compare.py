"""Run the registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else repr(0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return str(v)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda j: names[j])
    out = [tuple(_cell(r[j]) for j in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, sf_dir, name, query, sql) -> str:
    """Empty when equal, else a short description of the first difference."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = _rows(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(names)}\n  spark {a}\n  sql   {b} ({sum(x != y for x, y in zip(mine, theirs))} differ)"
    return "" if mine else "no rows on either side"
