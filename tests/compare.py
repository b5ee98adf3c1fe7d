"""Runs registered queries beside their DuckDB statements and compares rows.

python -m tests.compare [table directory] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_bool_dtype(column) or pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            frame[name] = column.astype(float)
        else:
            frame[name] = column.map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
    order = list(frame.columns)
    return frame.sort_values(order, na_position="first", key=_key).reset_index(drop=True)


def _key(column: pd.Series) -> pd.Series:
    return column.fillna(-np.inf) if pd.api.types.is_numeric_dtype(column) else column.fillna("").astype(str)


def difference(spark_frame: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """The first difference found, None if rows and columns agree exactly."""
    if sorted(spark_frame.columns) != sorted(expected.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(expected.columns)}"
    if len(spark_frame) != len(expected):
        return f"{len(spark_frame)} rows, expected {len(expected)}"
    left, right = _normal(spark_frame), _normal(expected)
    for name in left.columns:
        a, b = left[name], right[name]
        if pd.api.types.is_numeric_dtype(a) != pd.api.types.is_numeric_dtype(b):
            if a.isna().all() and b.isna().all():
                continue
            return f"{name}: {a.dtype} against {b.dtype}"
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = int((~same).idxmax())
            return f"{name}: {(~same).sum()} values differ, first {a[i]!r} against {b[i]!r}"
    return None


def main(args: list[str]) -> int:
    import __spark_entry__ as contract
    from shelfwise.session import local_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    queries, oracle = contract.queries(), contract.oracle_sql()
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in args[1:] or oracle:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            problem = difference(got, con.execute(oracle[name]).df()) if name in oracle else "no statement"
        except Exception as error:  # report and go on with the next query
            took, problem, got = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32} {len(got):7} rows {took:6.2f} s  {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
