"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import decimal
import datetime as dt
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v.is_integer() else round(v, 9))
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def difference(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows(names, cur.fetchall())
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(n.lower() for n in names) != sorted(c.lower() for c in df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours == theirs:
        return None
    only, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only ours {list(only)[:2]}; only theirs {list(missing)[:2]}"
    )
