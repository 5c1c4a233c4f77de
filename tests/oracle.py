"""Runs a registered query and its oracle SQL on the same tables and compares them as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return str(value) if type(value).__name__ in ("Timestamp", "datetime", "date", "Decimal") else value


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("set timezone = 'UTC'")
    cursor = con.execute(sql)
    return [x[0] for x in cursor.description], cursor.fetchall()


def differences(df, sql: str, sf_dir: str) -> str:
    """Empty if columns and rows agree."""
    names, rows = sql_rows(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    place = {n: i for i, n in enumerate(names)}
    want = Counter(tuple(plain(r[place[n]]) for n in order) for r in rows)
    got = Counter(tuple(plain(r[n]) for n in order) for r in df.select(*order).collect())
    if want == got:
        return ""
    return f"{sum(got.values())} and {sum(want.values())} rows; only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
