"""Compare registered queries with their reference SQL (order-free, exact values)."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v if v is None or isinstance(v, (str, bool)) else str(v)


def differences(spark, con, run, sql: str, sf_dir: str, show: int = 4) -> list[str]:
    made = run(spark, sf_dir)
    cols = sorted(made.columns)
    ours = [tuple(_value(row[c]) for c in cols) for row in made.collect()]
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    if sorted(names) != cols:
        return [f"columns differ: {sorted(set(names) ^ set(cols))}"]
    at = [names.index(c) for c in cols]
    theirs = [tuple(_value(row[i]) for i in at) for row in got.fetchall()]
    if sorted(map(repr, ours)) == sorted(map(repr, theirs)):
        return []
    out = [f"rows {len(ours)} / {len(theirs)}"]
    left, right = sorted(set(ours) - set(theirs), key=repr), sorted(set(theirs) - set(ours), key=repr)
    for a, b in list(zip(left, right))[:show]:
        out.append(str([(c, x, y) for c, x, y in zip(cols, a, b) if x != y][:6]))
    out.append(f"only ours {len(left)}, only theirs {len(right)}; e.g. {left[:1]} {right[:1]}"[:700])
    return out
