"""Run every registered query against its DuckDB oracle, like the driver does.

Usage: python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
Compares row count, column names and the multiset of rows (columns sorted by
name, floats normalised to repr, NaN and NULL kept apart).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", repr(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("d", v.isoformat())
    if hasattr(v, "item"):
        return norm(v.item())
    return (type(v).__name__, v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), sorted(cols)


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(key=key, rows=len(s_rows), oracle=None, spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    a, ac = rows_of(s_cols, s_rows)
    b, bc = rows_of(d_cols, d_rows)
    ok = ac == bc and a == b
    out = dict(key=key, rows=len(s_rows), oracle_rows=len(d_rows), cols_ok=ac == bc, match=ok,
               spark_s=round(t1 - t0, 2))
    if not ok:
        out["spark_cols"] = ac
        out["oracle_cols"] = bc
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:3]
        out["only_oracle"] = list(sb - sa)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from dockplan.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k in sorted(qs):
        if keys and k not in keys:
            continue
        try:
            r = compare(spark, con, sf_dir, k, qs[k], orc.get(k))
        except Exception as e:  # report and go on
            r = dict(key=k, error=repr(e)[:800])
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
