"""Compare a query with its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb

DATA = os.environ.get("SILTWORKS_TESTDATA", "/root/testdata/sf0.001")


def connect():
    con = duckdb.connect()
    for name in sorted(os.listdir(DATA)):
        con.sql(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")
    return con


def _plain(v):
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else str(v) if isinstance(v, float) else v


def check(spark, con, query, sql):
    df = query(spark, DATA)
    columns = sorted(df.columns)
    want = con.sql(sql)
    assert sorted(want.columns) == columns
    at = [list(want.columns).index(c) for c in columns]
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(_plain(r[k]) for k in at) for r in want.fetchall()), key=repr)
