"""Compares a query's rows with its SQL in DuckDB, as multisets of values, columns by name."""

import datetime
import glob
import os
from collections import Counter

FOLDER = os.environ.get("SASTRA_TESTDATA", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def connection():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


def differences(con, sql, df):
    """Rows that only the SQL has, and rows that only the query has."""
    found = con.sql(sql)
    names = sorted(df.columns)
    assert sorted(found.columns) == names
    want = Counter(repr(plain([row[found.columns.index(c)] for c in names])) for row in found.fetchall())
    got = Counter(repr(plain([row[c] for c in names])) for row in df.collect())
    return want - got, got - want
