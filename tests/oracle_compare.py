"""Run catalog queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    if sql is None:
        return {"key": key, "status": "NO_ORACLE", "rows": len(s_rows), "t": t_spark}
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    out = {"key": key, "rows": len(s_rows), "oracle_rows": len(d_rows), "t": round(t_spark, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "COLS"
        out["detail"] = f"spark={s_cols} duck={d_cols}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "OK"
    else:
        out["status"] = "VALUES"
        diff_a = list((a - b).elements())[:3]
        diff_b = list((b - a).elements())[:3]
        out["detail"] = f"cols={sorted(s_cols)} spark_only={diff_a} duck_only={diff_b}"
    out["types"] = {c: (s_types[c], d_types[c]) for c in s_cols}
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from starledger.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("oracle-compare")
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or sorted(qs)):
        try:
            r = compare(spark, con, k, qs[k], oracles.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "detail": repr(e)[:600]}
        if r["status"] not in ("OK", "NO_ORACLE"):
            bad += 1
        print(r, flush=True)
    print(f"TOTAL {len(keys or qs)} BAD {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
