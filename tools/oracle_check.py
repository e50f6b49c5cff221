"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tools/oracle_check.py [--sf DIR] [name-or-prefix ...]

Compares row count, column names, column types (coarse), and an
order-insensitive hash of the values with columns sorted by name.
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidewater.session import build_session  # noqa: E402
from tidewater.sources.tables import SCHEMAS  # noqa: E402
from tidewater.plans.registry import all_queries  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session()
    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs = all_queries()
    sel = [n for n in qs if not a.names or any(n == p or n.startswith(p) for p in a.names)]
    ok = bad = 0
    for n in sel:
        q = qs[n]
        t0 = time.time()
        try:
            sdf = q.fn(spark, a.sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"ROWS {n}: {len(srows)} rows ({ts:.1f}s) no oracle")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        hs, ls = _hash(scols, srows)
        hd, ld = _hash(dcols, drows)
        stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
        dtypes = [str(d[1]) for d in res.description]
        if sorted(scols) != sorted(dcols) or len(srows) != len(drows) or hs != hd:
            bad += 1
            print(f"FAIL {n}: cols {scols} vs {dcols}; rows {len(srows)} vs {len(drows)}; hash {hs} vs {hd}")
            diff_s = [x for x in ls if x not in set(ld)][:5]
            diff_d = [x for x in ld if x not in set(ls)][:5]
            print("   spark-only:", diff_s)
            print("   duck-only: ", diff_d)
        else:
            tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}
            sd = dict(zip(scols, stypes))
            dd = dict(zip(dcols, dtypes))
            mism = [(c, sd[c], dd[c]) for c in scols if tmap.get(sd[c], sd[c]) != dd[c]]
            ok += 1
            flag = f" TYPE-MISMATCH {mism}" if mism else ""
            print(f"OK   {n}: {len(srows)} rows ({ts:.1f}s){flag}")
            if a.show:
                print("   ", ls[:3])
    print(f"== {ok} ok, {bad} failed, {len(sel)} total")
    spark.stop()


if __name__ == "__main__":
    main()
