"""Run registered queries in Spark and their SQL oracles in DuckDB and compare the results.

    python tools/check_oracle.py [--sf DIR] [name ...]

Compares column names, row counts and the multiset of rows (floats rounded to 6 places).
Mirrors the correctness gate; it is a development aid, not part of the library.
"""

from __future__ import annotations

import argparse
import collections
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from affinity.plans import ORACLES, QUERIES  # noqa: E402
from affinity.session import build_session  # noqa: E402
from affinity.sources.tables import TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    names = a.names or sorted(QUERIES)
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, a.sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad.append(name)
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            print(f"{name}: rows={len(rows)} (no oracle) {ts:.1f}s")
            continue
        t1 = time.time()
        try:
            res = con.execute(ORACLES[name])
            ocols = [d[0] for d in res.description]
            orows = [tuple(r) for r in res.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SQL ERROR {str(e)[:400]}")
            bad.append(name)
            continue
        to = time.time() - t1
        ok_cols = sorted(cols) == sorted(ocols)
        if ok_cols:
            idx = [ocols.index(c) for c in cols]
            orows = [tuple(r[i] for i in idx) for r in orows]
        c1 = collections.Counter(tuple(norm(v) for v in r) for r in rows)
        c2 = collections.Counter(tuple(norm(v) for v in r) for r in orows)
        same = ok_cols and c1 == c2
        print(f"{name}: {'OK' if same else 'MISMATCH'} rows={len(rows)}/{len(orows)} spark={ts:.1f}s sql={to:.1f}s"
              + ("" if ok_cols else f" cols={cols} vs {ocols}"))
        if not same:
            bad.append(name)
            if ok_cols:
                d1 = list((c1 - c2).items())[:3]
                d2 = list((c2 - c1).items())[:3]
                print("   spark-only:", d1)
                print("   sql-only:  ", d2)
    print("BAD:", bad)


if __name__ == "__main__":
    main()
