"""Compare registered Spark queries with their DuckDB SQL on the same tables.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v.is_integer() and abs(v) < 2**53 else round(v, 9)
    return v


def canonical(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = canonical(spark_pdf), canonical(duck_pdf)
    for x, y in zip(a, b):
        if x != y:
            return f"first differing row: {x} vs {y}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from __spark_entry__ import oracle_sql, queries
    from farecast.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            pdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:20s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t
        if name not in sql:
            print(f"{name:20s} rows={len(pdf):7d} {dt:6.1f}s  (no oracle)")
            continue
        try:
            ddf = con.sql(sql[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:20s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        err = compare(pdf, ddf)
        bad += err is not None
        print(f"{name:20s} rows={len(pdf):7d} {dt:6.1f}s  {'OK' if err is None else 'MISMATCH ' + err[:300]}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
