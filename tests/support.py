"""Runs a query's SQL in DuckDB over the same tables and compares all rows."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET threads = 2")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = con.execute(sql)
    return [c[0] for c in out.description], out.fetchall()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1.1e-6)
    return a == b and (a is None or b is None or isinstance(a, bool) == isinstance(b, bool))


def compare(frame, sql, sf_dir):
    names, want = rows_of(sql, sf_dir)
    assert sorted(names) == sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*names).collect()]
    key = lambda r: tuple((x is None, f"{x:.4f}" if isinstance(x, float) else str(x)) for x in r)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(map(same, a, b)), (names, a, b)
    return len(got)
