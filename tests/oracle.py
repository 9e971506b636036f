"""Runs a query in Spark and its SQL in DuckDB over the same tables and compares all rows."""

import glob
import math
import os

import duckdb


def connect(base):
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for p in glob.glob(f"{base}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def _plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


def rows_of(spark, con, query, sql, base):
    df = query(spark, base)
    cols = sorted(df.columns)
    mine = sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())
    theirs = con.sql("select " + ", ".join(f'"{c}"' for c in cols) + f" from ({sql})").fetchall()
    return mine, sorted(tuple(map(_plain, r)) for r in theirs)
