"""Compare registered queries with their SQL twins: ``python tests/oracle.py [sf] [name…]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def compare(spark, con, folder: str, run, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    got, want = run(spark, folder).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = _norm(got), _norm(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if str(a.dtype) != str(b.dtype):
            return f"{c}: type {a.dtype} != {b.dtype}"
        bad = ~((a == b) | (a.isna() & b.isna()))
        if bad.any():
            i = bad.idxmax()
            return f"{c}: {bad.sum()} differ, e.g. {got.loc[i].to_dict()!r:.600} != {want.loc[i].to_dict()!r:.600}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from quireflow.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = get_spark("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    twins = entry.oracle_sql()
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in twins:
                problem = compare(spark, con, folder, run, twins[name])
                note = problem or "same"
            else:
                problem, note = None, f"rows only: {run(spark, folder).count()}"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = note = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
