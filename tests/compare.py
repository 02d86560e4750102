"""Run registered queries against their SQL on one scale factor and compare.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for col in df.columns:
        values = df[col]
        if str(values.dtype).startswith("datetime"):
            df[col] = values.astype("datetime64[us]").astype(str)
        elif values.dtype == object or "str" in str(values.dtype):
            df[col] = values.map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
    return df.sort_values(list(df.columns), ignore_index=True, na_position="first")


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs between two results, ignoring row and column order."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got, want = _plain(got), _plain(want)
    for col in got.columns:
        a, b = got[col], want[col]
        if pd.api.types.is_numeric_dtype(a) != pd.api.types.is_numeric_dtype(b):
            return f"{col}: {a.dtype} != {b.dtype}"
        if str(a.dtype).lower() != str(b.dtype).lower() and a.notna().all():
            return f"{col}: {a.dtype} != {b.dtype}"
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = int((~same).idxmax())
            return f"{col}: row {i}: {a[i]!r} != {b[i]!r}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from revtide.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = entry.queries()[name](spark, sf_dir).toPandas()
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            if sql is None:
                verdict = f"rows only: {len(got)}"
            else:
                problem = difference(got, con.execute(sql).df())
                verdict = problem or f"ok {len(got)}"
                bad += problem is not None
        except Exception as exc:  # noqa: BLE001
            took, bad = time.time() - start, bad + 1
            verdict = f"{type(exc).__name__}: {str(exc)[:400]}"
        print(f"{name:28} {took:6.2f}s {verdict}", flush=True)
    print("different:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
