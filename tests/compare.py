"""Run a query on Spark and its SQL on DuckDB and compare whole results.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _value(value):
    if value is None or value is pd.NaT or value != value:
        return None
    return value


def rows_of(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in records)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.session import local_session

    spark = local_session()
    connection = oracle(sf_dir)
    sql, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names or name not in sql:
            continue
        began = time.time()
        columns, got = spark_rows(query(spark, sf_dir))
        middle = time.time()
        expected_columns, expected = oracle_rows(connection, sql[name])
        same = columns == expected_columns and got == expected
        failed += not same
        print(
            f"{'ok  ' if same else 'DIFF'} {name}: {got.total()} rows, "
            f"spark {middle - began:.1f}s, duckdb {time.time() - middle:.1f}s"
        )
        if not same:
            print("  columns", columns, expected_columns)
            print("  extra  ", list((got - expected).items())[:3])
            print("  missing", list((expected - got).items())[:3])
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]))
