"""Compares registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf] [name part ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "0.000000" if abs(v) < 5e-7 else f"{v:.6f}"
    return str(v)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql: str | None, sf_dir: str) -> tuple[str, int]:
    """('ok' | 'rows only' | what differs, number of rows)."""
    df = fn(spark, sf_dir)
    cols, rows = normal(df.columns, df.collect())
    if sql is None:
        return "rows only", len(rows)
    res = con.execute(sql)
    want_cols, want = normal([d[0] for d in res.description], res.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}", len(rows)
    if len(rows) != len(want):
        return f"rows {len(rows)} != {len(want)}", len(rows)
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    return ("ok", len(rows)) if not bad else (f"{len(bad)} rows differ, e.g. {bad[0]}", len(rows))


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidewatch.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    spark, con = build_session(cpus=8), connect(sf_dir)
    sqls, failed = oracle_sql(), 0
    for name, fn in queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        t = time.time()
        try:
            verdict, n = compare(spark, con, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            verdict, n = f"{type(e).__name__}: {str(e)[:600]}", 0
        failed += verdict not in ("ok", "rows only")
        print(f"{name:36} {n:7} {time.time() - t:6.1f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
