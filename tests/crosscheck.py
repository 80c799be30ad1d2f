"""Run registered queries in Spark and their DuckDB SQL side by side.

    python tests/crosscheck.py [sf_dir] [name ...]

Prints one line per query: row counts, column names, and whether the
order-insensitive multisets of rows are equal.
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def duck_connection(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, spark_rows=len(s_rows), oracle=None, spark_s=t1 - t0)
    rel = con.sql(sql)
    d_cols_raw = rel.columns
    d_data = rel.fetchall()
    t2 = time.time()
    d_cols = sorted(d_cols_raw)
    idx = [d_cols_raw.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_data]
    same_cols = s_cols == d_cols
    ok = same_cols and collections.Counter(s_rows) == collections.Counter(d_rows)
    res = dict(name=name, spark_rows=len(s_rows), duck_rows=len(d_rows), cols_ok=same_cols,
               match=ok, spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if not ok:
        sc, dc = collections.Counter(s_rows), collections.Counter(d_rows)
        res["only_spark"] = list((sc - dc).elements())[:3]
        res["only_duck"] = list((dc - sc).elements())[:3]
        if not same_cols:
            res["spark_cols"], res["duck_cols"] = s_cols, d_cols
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from spanshade.session import local_session
    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:1500]}")
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
