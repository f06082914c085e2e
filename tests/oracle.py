"""Comparison of query results with DuckDB SQL over the same tables."""

import math
import os

import duckdb

from reportloom.plans.base import TABLES


def connected(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return c


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.6f}"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in data)


def compare(df, con, sql):
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
