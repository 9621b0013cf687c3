"""Compare a Spark result with the SQL result of another engine, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, otherwise a short report."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    mine = _rows(df.columns, df.collect())
    theirs = _rows(names, result.fetchall())
    kinds_mine = [type(v).__name__ for v in next(iter(mine))] if mine else []
    kinds_theirs = [type(v).__name__ for v in next(iter(theirs))] if theirs else []
    if mine == theirs:
        if kinds_mine != kinds_theirs:
            return f"types {sorted(df.columns)} {kinds_mine} != {kinds_theirs}"
        return None
    extra, missing = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; {sorted(df.columns)}\n"
        f"  only Spark: {list(extra)[:2]}\n  only SQL:   {list(missing)[:2]}"
    )
