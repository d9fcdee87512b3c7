"""Run every registered query on Spark and its oracle SQL on DuckDB, compare.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows, schema and order-insensitive value match.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costmart.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from costmart.session import build_session  # noqa: E402
from tests.compare import canon, duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = ORACLE_SQL.get(name)
        if sql is None:
            print(f"{name:32s} rows={len(srows):8d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        ok_rows = len(srows) == len(drows)
        ok_vals = ok_cols and canon(scols, [tuple(r) for r in srows]) == canon(dcols, drows)
        flag = "OK " if (ok_cols and ok_rows and ok_vals) else "BAD"
        bad += flag == "BAD"
        print(f"{name:32s} {flag} rows={len(srows)}/{len(drows)} cols={'ok' if ok_cols else (scols, dcols)} "
              f"vals={'ok' if ok_vals else 'DIFF'} {ts:.1f}s")
        if flag == "BAD" and ok_cols and os.environ.get("SHOW_DIFF"):
            a, b = canon(scols, [tuple(r) for r in srows]), canon(dcols, drows)
            sa, sb = set(a), set(b)
            print("   spark-only:", list(sa - sb)[:5])
            print("   duck-only: ", list(sb - sa)[:5])
    print(f"-- {len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
