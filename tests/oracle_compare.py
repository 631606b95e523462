"""Run every registered query against its DuckDB oracle and report matches.

    python tests/oracle_compare.py [sf_dir] [name ...]

Mirrors the driver's check: row count, column names, and an
order-insensitive hash of the values (floats to 6 decimals, timestamps as
ISO text).  Exit status 1 when anything differs.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.standins import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr([norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and go on
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:28s} rows={len(rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sql[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:
            print(f"{name:28s} ORACLE ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        status = "OK " if ok else "DIFF"
        print(f"{name:28s} {status} rows={len(rows):7d}/{len(orows):7d} {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(ocols):
                print("   cols spark :", sorted(cols))
                print("   cols oracle:", sorted(ocols))
            a, b = set(l1), set(l2)
            for x in sorted(a - b)[:3]:
                print("   spark only :", x[:300])
            for x in sorted(b - a)[:3]:
                print("   oracle only:", x[:300])
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
