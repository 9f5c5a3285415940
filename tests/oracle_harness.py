"""Run a registered query in Spark and its oracle SQL in DuckDB on the same
parquet tables; compare row count, column names and the multiset of values.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, decimal.Decimal):
        return (1, format(v.normalize(), "f") if v == v else "nan")
    if isinstance(v, float):
        return (1, repr(round(v, 9)))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, format(decimal.Decimal(v), "f"))
    if isinstance(v, (dt.datetime, dt.date)):
        return (3, v.isoformat())
    if isinstance(v, (bytes, bytearray)):
        return (4, bytes(v).hex())
    return (5, str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"SCHEMA spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    if a == b:
        out["status"] = "OK"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "VALUES"
        out["only_spark"] = [x for x in a if x not in sb][:3]
        out["only_oracle"] = [x for x in b if x not in sa][:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from orderstream.session import local_session
    import __spark_entry__ as E

    spark = local_session(8)
    names = argv[2:] or list(E.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as exc:  # report and go on
            r = {"name": n, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
