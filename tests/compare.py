"""A query's rows against those of SQL over the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def views(sf_dir: str, *tables: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def matches_oracle(spark, con, query, sql: str, sf_dir: str) -> None:
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in idx) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want
