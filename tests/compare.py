"""Run queries on Spark and their SQL on DuckDB, and compare rows as multisets of values."""

from __future__ import annotations

import math
import os
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if Path(path).is_dir() else path}'")
    return con


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, bool) or x is None:
        return x
    return str(x)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(value(row[k]) for k in order) for row in rows)


def differences(df, con, sql) -> str:
    """Empty where the frame equals the SQL's result."""
    got = multiset(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    wanted = multiset(names, result.fetchall())
    if got == wanted:
        return ""
    less, more = wanted - got, got - wanted
    return f"{sum(got.values())} and {sum(wanted.values())} rows; {sum(more.values())} differ: {list(more.items())[:3]} for {list(less.items())[:3]}"
