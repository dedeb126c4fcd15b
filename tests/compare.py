"""Order-insensitive comparison of a Spark result with DuckDB's."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, decimal.Decimal)):
        return str(v.normalize() if isinstance(v, decimal.Decimal) and v == v.to_integral() else v) if isinstance(v, decimal.Decimal) else str(v)
    if isinstance(v, float):
        return f"{v + 0.0:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def same(df, con, sql):
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    want = rows_of(names, res.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want), (len(got), len(want))
    assert got == want, next((g, w) for g, w in zip(got, want) if g != w)
