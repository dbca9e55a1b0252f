"""Runs a query's SQL in DuckDB over the same tables and compares all rows."""

import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({files!r})")
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    return names, out.fetchall()


def compare(frame, sql, sf_dir):
    names, want = rows_of(sql, sf_dir)
    assert sorted(names) == sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*names).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return len(got)
