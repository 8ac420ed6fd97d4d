"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Usage: python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
        return v.date() if v == v.replace(hour=0, minute=0, second=0, microsecond=0) else v
    import datetime as _dt
    if isinstance(v, _dt.datetime) and v == v.replace(hour=0, minute=0, second=0, microsecond=0):
        return v.date()
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None, verbose=True):
    import __spark_entry__ as e
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = e.queries()[name](spark, sf_dir)
    left = sdf.toPandas()
    t1 = time.time()
    sql = e.oracle_sql().get(name)
    if sql is None:
        if verbose:
            print(f"{name}: rows-only {len(left)} rows ({t1 - t0:.1f}s)")
        return True
    right = con.execute(sql).fetchdf()
    lc, lr = canon(left)
    rc, rr = canon(right)
    ok = lc == rc and len(lr) == len(rr) and lr == rr
    if verbose and lc == rc:
        ld = {c: str(left[c].dtype) for c in lc}
        rd = {c: str(right[c].dtype) for c in rc}
        diff = {c: (ld[c], rd[c]) for c in lc if ld[c] != rd[c]}
        if diff:
            print(f"  dtype differences {name}: {diff}")
    if verbose:
        print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(lr)} duck={len(rr)} ({t1 - t0:.1f}s)")
        if not ok:
            if lc != rc:
                print("  columns", lc, rc)
                print("  dtypes spark", dict(left.dtypes), "duck", dict(right.dtypes))
            else:
                left_rows, right_rows = set(lr), set(rr)
                diff_l = [r for r in lr if r not in right_rows][:3]
                diff_r = [r for r in rr if r not in left_rows][:3]
                print("  spark-only", diff_l)
                print("  duck-only ", diff_r)
    return ok


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from cartwheel.session import build_session
    import __spark_entry__ as e
    spark = build_session("local[8]", 8)
    con = duck(sf)
    names = names or sorted(e.queries())
    bad = [n for n in names if not compare(spark, n, sf, con)]
    print("FAILED:", bad)
