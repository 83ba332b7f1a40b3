"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, schema and order-insensitive value-hash agreement.
"""
from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return f"{float(v):.6f}"
    return str(v)


def frame_digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from leadlens.session import build_session
    spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if k not in sqls:
            print(f"{k:32s} rows={len(srows):7d} (no oracle) {time.time()-t:.1f}s")
            continue
        try:
            rel = con.sql(sqls[k])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = frame_digest(srows, scols)
        hd, ld = frame_digest(drows, dcols)
        ok = len(srows) == len(drows) and sorted(scols) == sorted(dcols) and hs == hd
        bad += not ok
        print(f"{k:32s} rows {len(srows)}/{len(drows)} schema={'ok' if sorted(scols)==sorted(dcols) else 'DIFF'} "
              f"hash={'ok' if hs==hd else 'DIFF'} {time.time()-t:.1f}s")
        if not ok:
            if sorted(scols) != sorted(dcols):
                print("   spark cols:", scols, "\n   duck  cols:", dcols)
            else:
                a, b = set(ls), set(ld)
                print("   only spark:", list(a - b)[:3], "\n   only duck :", list(b - a)[:3])
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv)
