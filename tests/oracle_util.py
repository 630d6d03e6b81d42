"""Spark-vs-DuckDB comparison used by the tests and tools/oracle_check.py."""

from __future__ import annotations

import math

import duckdb

from tidemark.plans.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, repr([norm(x) for x in v]))
    return (1, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def same_result(sdf, con, sql):
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols), (sorted(sdf.columns), sorted(dcols))
    assert len(srows) == len(drows)
    a, b = canon(sdf.columns, srows), canon(dcols, drows)
    assert a == b, (set(a) - set(b), set(b) - set(a))
