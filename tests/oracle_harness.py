"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]

Mirrors the driver's check: same column names, same row count, same
order-insensitive values (dates as ISO text, floats rounded to 6 places).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    info = {"name": name, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
            "rows": (len(s_rows), len(d_rows))}
    if sorted(s_cols) != sorted(d_cols):
        info["ok"] = False
        info["why"] = f"columns {sorted(s_cols)} vs {sorted(d_cols)}"
        return info
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    info["ok"] = a == b
    if not info["ok"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        info["why"] = f"first diffs {diff}" if len(a) == len(b) else "row count"
    return info


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as se
    from churnlens.session import get_spark

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, orc = se.queries(), se.oracle_sql()
    bad = 0
    for n in names or list(qs):
        if n not in orc:
            df = qs[n](spark, sf_dir)
            print({"name": n, "rows_only": df.count()})
            continue
        info = compare(spark, con, sf_dir, n, qs[n], orc[n])
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
