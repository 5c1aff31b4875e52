"""Runs a query and its SQL over the smallest tables and compares the rows."""

import datetime
import decimal
import glob
import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def views(sf=SF):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, float | decimal.Decimal):
        return "nan" if math.isnan(x) else round(float(x), 6)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def same(spark, query, sql, con, sf=SF):
    df = query(spark, sf)
    cols = sorted(df.columns)
    mine = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    theirs = sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in res.fetchall())
    assert mine == theirs
