"""Comparing a Spark result with DuckDB's."""

import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.5f}"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def same(df, con, sql):
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0]
    missing, extra = sorted(set(want[1]) - set(got[1]))[:3], sorted(set(got[1]) - set(want[1]))[:3]
    assert got[1] == want[1], f"{len(got[1])} rows, {len(want[1])} wanted; missing {missing}; extra {extra}"
