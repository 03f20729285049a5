"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python scripts/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from quillprice.oracle.compare import compare, duckdb_connection  # noqa: E402
from quillprice.registry import oracle_sql, queries  # noqa: E402
from quillprice.session import local_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    spark = local_session()
    con = duckdb_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k not in sqls:
                print(f"{k:40s} rows={df.count():7d} (no oracle)")
                continue
            ok, ns, nd, detail = compare(df, con, sqls[k])
        except Exception as e:  # noqa: BLE001
            print(f"{k:40s} ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        print(f"{k:40s} {'OK ' if ok else 'MISMATCH'} spark={ns:7d} duck={nd:7d} "
              f"{time.time() - t0:.1f}s {detail}")
        bad += not ok
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
