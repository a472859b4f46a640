"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).where(frame.notna(), None).map(
        lambda v: None if v is None else (
            str(pd.Timestamp(v)) if hasattr(v, "year") else
            repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
        )
    )
    return text.sort_values(list(text.columns), na_position="first").reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    left, right = canonical(spark_frame), canonical(sql_frame)
    unequal = (left.fillna("~") != right.fillna("~")).any(axis=1)
    if unequal.any():
        k = unequal.idxmax()
        return f"{int(unequal.sum())} rows differ, first: {left.loc[k].to_dict()} != {right.loc[k].to_dict()}"
    return ""


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    import __spark_entry__ as entry
    from tidemark import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder).toPandas()
            took = time.time() - start
            problem = differences(frame, con.execute(sqls[name]).df()) if name in sqls else ""
        except Exception as error:  # report and go on with the next query
            frame, took, problem = [], time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "ok  " if not problem else "FAIL"
        print(f"{kind} {name} rows={len(frame)} {took:.2f}s {problem}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
