"""Run registered queries next to their SQL and report differences.

Usage: python tools/check.py [--sf DIR] [key or prefix ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pandas as pd

from starforge.plans.registry import all_checks, all_queries
from starforge.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def norm(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, float):
            return repr(round(v, 6) + 0.0)
        return str(v)

    return sorted(tuple(norm(v) for v in row) for row in pdf.itertuples(index=False, name=None))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    checks, bad = all_checks(), []
    for key, fn in all_queries().items():
        if args.keys and not any(key == k or (k.endswith("_") and key.startswith(k)) for k in args.keys):
            continue
        start = time.time()
        try:
            df = fn(spark, args.sf)
            got = df.toPandas()
            took = time.time() - start
            if key not in checks:
                print(f"rows {key:8} {len(got):7} rows {took:6.2f}s")
                if not len(got):
                    bad.append(key)
                continue
            rel = con.execute(checks[key])
            want = rel.fetchdf()
            types = {d[0]: str(d[1]) for d in rel.description}
            a, b = rows_of(got), rows_of(want)
            st = {n: t.upper().replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("STRING", "VARCHAR") for n, t in df.dtypes}
            tdiff = {n: (st.get(n), types.get(n)) for n in set(st) | set(types)
                     if st.get(n) != types.get(n) and not (str(st.get(n)).startswith("ARRAY"))}
            ok = a == b and not tdiff
            print(f"{'ok  ' if ok else 'FAIL'} {key:8} {len(got):7} rows {took:6.2f}s")
            if not ok:
                bad.append(key)
                print("   types:", tdiff, " rows:", len(a), len(b))
                sa, sb = set(a), set(b)
                print("   only spark:", sorted(sa - sb)[:3])
                print("   only check:", sorted(sb - sa)[:3])
        except Exception as e:  # noqa: BLE001
            bad.append(key)
            print(f"FAIL {key:8} {type(e).__name__}: {str(e)[:1500]}")
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
