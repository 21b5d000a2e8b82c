"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from barlab.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    q = queries()[name]
    sql = oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    s_pd = pd.DataFrame(s_rows, columns=sdf.columns)
    ts = time.time() - t0
    if sql is None:
        return True, f"{name}: rows-only {len(s_pd)} ({ts:.1f}s)"
    o_pd = con.sql(sql).df()
    if sorted(s_pd.columns) != sorted(o_pd.columns):
        return False, f"{name}: columns differ spark={sorted(s_pd.columns)} oracle={sorted(o_pd.columns)}"
    if len(s_pd) != len(o_pd):
        return False, f"{name}: rows spark={len(s_pd)} oracle={len(o_pd)}"
    a, b = canon(s_pd), canon(o_pd)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{name}: {len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]} cols={sorted(s_pd.columns)}"
    types = {c: (str(s_pd[c].dtype), str(o_pd[c].dtype)) for c in s_pd.columns if str(s_pd[c].dtype) != str(o_pd[c].dtype)}
    note = f" dtypes {types}" if types else ""
    return True, f"{name}: OK {len(s_pd)} rows ({ts:.1f}s){note}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    from barlab.session import get_spark

    spark = get_spark(master="local[8]")
    con = duck(sf_dir)
    names = [n for n in queries() if not prefixes or any(n.startswith(p) for p in prefixes)]
    fails = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - fails}/{len(names)} passed")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
