"""Runs a named query and its SQL on the same Parquet tables and compares the results.

As a script: ``python -m tests.compare [folder] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return 0.0 if value == 0 and isinstance(value, float) else value


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [tuple(_cell(v) for v in row) for row in frame[columns].itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark_result: DataFrame, sql_result: pd.DataFrame) -> str:
    """Empty when both have the same columns, types of columns and rows."""
    ours = spark_result.toPandas()
    if sorted(ours.columns) != sorted(sql_result.columns):
        return f"columns {sorted(ours.columns)} != {sorted(sql_result.columns)}"
    if len(ours) != len(sql_result):
        return f"{len(ours)} rows != {len(sql_result)}"
    a, b = _rows(ours), _rows(sql_result)
    bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def main(argv: list[str]) -> int:
    from lotwise.catalog import all_queries, all_sql

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sql = all_queries(), all_sql()
    names = argv[1:] or list(queries)
    spark, con = session(), database(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = queries[name](spark, folder)
            if name in sql:
                built = time.time()
                expected = con.execute(sql[name]).df()
                start += time.time() - built
                problem = differences(result, expected)
                state = "OK" if not problem else f"DIFFERENT {problem}"
            else:
                state = f"rows only: {result.count()}"
        except Exception as error:  # report and go on
            state = f"ERROR {type(error).__name__} {str(error)[:600]}"
        failed += state.startswith(("DIFFERENT", "ERROR"))
        print(f"{name:24s} {time.time() - start:6.1f}s {state}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(bool(main(sys.argv[1:])))
