"""Runs a query and its SQL over the same tables and compares the rows."""

import glob
import math
import os
from collections import Counter

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def sql_rows(text, data=DATA):
    c = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    cols = sorted(c.sql(text).columns)
    got = c.sql("SELECT " + ", ".join(f'"{k}"' for k in cols) + f" FROM ({text})").fetchall()
    return cols, Counter(repr(plain(r)) for r in got)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(repr(plain(tuple(r))) for r in df.select(*cols).collect())
