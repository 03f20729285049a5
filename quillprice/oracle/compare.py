"""Side-by-side check of a Spark query and its DuckDB oracle SQL.

Compares column names and the multiset of rows (column order and row order
ignored); values are normalised so that a Spark DECIMAL and a DuckDB DECIMAL
of the same value compare equal.
"""

from __future__ import annotations

import math

from quillprice.fixtures_tables import TESTDATA_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TESTDATA_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(float(v)))
    if hasattr(v, "as_tuple"):
        return (1, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, repr(v))


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str):
    """Returns (ok, spark_rows, duck_rows, detail)."""
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(cols) != sorted(dcols):
        return False, len(srows), len(drows), f"columns {sorted(cols)} vs {sorted(dcols)}"
    a, b = canonical(cols, srows), canonical(dcols, drows)
    if a == b:
        return True, len(srows), len(drows), ""
    sb, sa = set(b), set(a)
    return False, len(srows), len(drows), (f"spark-only {[x for x in a if x not in sb][:2]} "
                                          f"duck-only {[x for x in b if x not in sa][:2]}")
