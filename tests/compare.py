"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/compare.py [sf_dir] [query ...]
Prints one line per query: name, rows (spark/duckdb), columns match, values match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def duck_rows(sf_dir: str, sql: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, res.fetchall()


def compare(spark, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    d_cols, d_rows = duck_rows(sf_dir, sql) if sql else (None, None)
    t2 = time.time()
    if sql is None:
        print(f"{name:28s} spark={len(s_rows):7d} (no oracle) {t1 - t0:.1f}s", flush=True)
        return True
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    dorder = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    cols_ok = sorted(s_cols) == sorted(d_cols)
    sv = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=repr)
    dv = sorted((tuple(_norm(r[i]) for i in dorder) for r in d_rows), key=repr)
    ok = cols_ok and sv == dv
    print(f"{name:28s} spark={len(s_rows):7d} duck={len(d_rows):7d} cols={cols_ok} values={sv == dv} "
          f"{t1 - t0:.1f}s/{t2 - t1:.1f}s", flush=True)
    if not ok:
        if not cols_ok:
            print("   spark cols", s_cols, "\n   duck cols ", d_cols)
        a, b = set(sv), set(dv)
        print("   only spark:", list(a - b)[:3])
        print("   only duck: ", list(b - a)[:3])
    return ok


def main():
    from termscope.session import local_session
    import __spark_entry__ as e
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session(8, 8)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = []
    for n, fn in qs.items():
        if names and n not in names:
            continue
        try:
            if not compare(spark, n, fn, sqls.get(n), sf_dir):
                bad.append(n)
        except Exception as ex:  # report and go on
            print(f"{n:28s} ERROR {type(ex).__name__}: {str(ex)[:800]}", flush=True)
            bad.append(n)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
