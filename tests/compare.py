"""Run a query and its SQL on the same tables; compare as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_engine(folder: str):
    engine = duckdb.connect()
    for name in TABLES:
        engine.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return engine


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, engine, sql: str) -> list[str]:
    mine = df.collect()
    found = engine.execute(sql)
    names = [d[0] for d in found.description]
    theirs = found.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} != {len(theirs)}")
    a, b = multiset(df.columns, mine), multiset(names, theirs)
    if a != b:
        problems.append(f"only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}")
    return problems
