"""Run registered queries in Spark and their oracle in DuckDB, compare.

Mimics the verify step: row count, column names, order-insensitive values.
Usage: python tools/compare.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import struct
import sys
import time

EXACT = os.environ.get("EXACT") == "1"

import duckdb

sys.path.insert(0, ".")
from driftcast.fixtures import BASE_TABLES  # noqa: E402
from driftcast.plans.registry import registry  # noqa: E402
from driftcast.session import get_spark  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN " + struct.pack(">d", v).hex()  # bit for bit: a NaN with another sign is another value
        if EXACT or abs(v) == math.inf:
            return repr(v)
        return repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, dict):  # struct: values in field order (like a Spark Row)
        v = list(v.values())
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    return repr(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, (fn, sql) in registry().items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            tbl = df.toArrow()
            srows = [tuple(r[c] for c in tbl.column_names) for r in tbl.to_pylist()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"rows {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            ok += 1
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if len(a) != len(b) or a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)} first diffs={diff}")
            bad += 1
        else:
            print(f"ok   {name}: {len(a)} rows {ts:.1f}s")
            ok += 1
    print(f"{ok} ok, {bad} failed")


if __name__ == "__main__":
    main()
