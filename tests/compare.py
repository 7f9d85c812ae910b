"""Rows of a Spark query against rows of DuckDB on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb
import pandas as pd


def connect(root: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{root}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        t = pd.Timestamp(v)
        return str(t.tz_localize(None) if t.tz else t)
    return str(v) if isinstance(v, (list, dict, datetime.date)) else v


def same(df, con, sql: str) -> None:
    rows = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    a = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=repr)
    b = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
    assert a == b
