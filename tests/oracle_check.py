"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usable as a script: ``python tests/oracle_check.py [sf_dir] [key ...]``.
Comparison is order-insensitive over columns sorted by name, as the driver does.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, sf_dir: str, key: str) -> tuple[bool, str]:
    t0 = time.time()
    df = E.queries()[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(E.oracle_sql()[key])
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({len(a)} rows), first: {diff}"
    return True, f"{len(a)} rows, spark {t1 - t0:.1f}s"


def main(argv):
    from clinark.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.oracle_sql())
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, con, sf_dir, k)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k}: {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
