"""Rows of a Spark query against those of its SQL in DuckDB, whatever their order."""

import decimal
import glob
import math
import os

import duckdb
import numpy as np


def connect(folder):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f + '/*.parquet' if os.path.isdir(f) else f}')")
    return con


def plain(v):
    """Null, NaN, booleans, whole numbers and others stay apart; floats to ten digits, which sums in another order keep."""
    if v is None:
        return "null"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, np.integer)):
        return str(int(v))
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v) + 0.0:.10g}f"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def assert_same(df, con, sql):
    got = df.collect()
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, want.fetchall())
