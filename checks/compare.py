"""Run every query in Spark and in DuckDB and compare the results.

    python -m checks.compare [table folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns, ignore_index=True) if len(frame) else frame[columns]


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    left, right = normal(spark_frame), normal(sql_frame)
    kinds = [(c, str(left[c].dtype), str(right[c].dtype)) for c in left if left[c].dtype != right[c].dtype]
    if kinds:
        return f"types {kinds}"
    for column in left.columns:
        a, b = left[column], right[column]
        differs = ~((a == b) | (a.isna() & b.isna()))
        if differs.any():
            return f"{differs.sum()} values of {column}, e.g. {a[differs].iloc[0]!r} / {b[differs].iloc[0]!r}"
    return None


def check(spark: SparkSession, folder: str, name: str) -> str | None:
    spark_frame = QUERIES[name](spark, folder).toPandas()
    if name not in ORACLE:
        return None
    return difference(spark_frame, duck_connection(folder).execute(ORACLE[name]).df())


def main() -> int:
    from opinara.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = check(spark, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
