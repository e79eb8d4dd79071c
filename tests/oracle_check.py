"""Runs registered queries next to their SQL twins and compares rows.

``PYTHONPATH=. python tests/oracle_check.py DATA_FOLDER [QUERY ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

import __spark_entry__ as contract


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, (list, tuple)):
        return tuple(_canonical(item) for item in value)
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda index: names[index])
    return Counter(tuple(_canonical(row[index]) for index in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the Spark rows and the SQL rows; empty when they agree."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = _rows(df.columns, df.collect())
    if not expected:
        return ["no rows"]
    missing, extra = expected - actual, actual - expected
    if not missing and not extra:
        return []
    return [
        f"{sum(actual.values())} rows against {sum(expected.values())}",
        f"missing {str(list(missing)[:2])[:600]}",
        f"extra {str(list(extra)[:2])[:600]}",
    ]


def main(sf_dir: str, names: list[str]) -> int:
    """Print the state and time of the named queries, or of all."""
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    queries, oracle = contract.queries(), contract.oracle_sql()
    connection, failed = connect(sf_dir), 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = differences(df, connection, oracle[name]) if name in oracle else []
            state = "DIFF" if found else "match" if name in oracle else f"rows {df.count()}"
        except Exception as error:
            found, state = [str(error)[:700]], "ERROR"
        failed += bool(found)
        print(f"{name:32s} {time.time() - start:6.2f}s {state} {found or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
