"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def normalize(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    a = pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns)
    b = con.execute(sql).df()
    if sorted(a.columns) != sorted(b.columns):
        return False, f"columns differ: {sorted(a.columns)} vs {sorted(b.columns)}"
    if len(a) != len(b):
        return False, f"row count {len(a)} vs {len(b)}"
    ra, rb = normalize(a), normalize(b)
    for x, y in zip(ra, rb):
        if x != y:
            return False, f"first diff: spark={x} duck={y}"
    return True, f"{len(a)} rows"


def main(argv: list[str]) -> int:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from civic_mart.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = local_session()
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in sql:
            n = fn(spark, sf_dir).count()
            print(f"{name:32s} ROWS-ONLY {n} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            ok, msg = compare(fn(spark, sf_dir), con, sql[name])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {msg} ({time.time() - t0:.1f}s)", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
