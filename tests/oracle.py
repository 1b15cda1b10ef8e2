"""Compare registered queries with their SQL twins: names, types and rows, in any order.

Run as a script for one scale: ``python -m tests.oracle /root/testdata/sf0.01 [query ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _normal_type(dtype: pa.DataType) -> str:
    if pa.types.is_large_string(dtype) or pa.types.is_string(dtype):
        return "string"
    return str(dtype)


def _described(table: pa.Table) -> tuple[list[tuple[str, str]], Counter]:
    names = sorted(table.column_names)
    schema = [(name, _normal_type(table.schema.field(name).type)) for name in names]
    columns = [table.column(name).to_pylist() for name in names]
    return schema, Counter(map(repr, zip(*columns)))


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    """Human-readable differences, empty when the results are equal."""
    left_schema, left_rows = _described(spark_table)
    right_schema, right_rows = _described(sql_table)
    found = []
    if left_schema != right_schema:
        found.append(f"schema only spark {set(left_schema) - set(right_schema)}, only sql {set(right_schema) - set(left_schema)}")
    if left_rows != right_rows:
        found.append(f"rows spark {spark_table.num_rows}, sql {sql_table.num_rows}")
        found += [f"only spark: {row}" for row in list(left_rows - right_rows)[:2]]
        found += [f"only sql:   {row}" for row in list(right_rows - left_rows)[:2]]
    return found


def main(sf_dir: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidewatch.session import build_session

    spark = build_session("oracle-check", "local[8]", 8, **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(sf_dir), oracle_sql(), 0
    unknown = set(sql) - set(queries())
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = run(spark, sf_dir).toArrow()
            took = time.time() - start
            if name not in sql:
                print(f"rows {name}: {result.num_rows} rows in {took:.1f}s")
                continue
            found = differences(result, connection.execute(sql[name]).to_arrow_table())
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result, took, found = None, time.time() - start, [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name}: {result.num_rows if result else '-'} rows in {took:.1f}s")
        for line in found:
            print("     ", line[:1600])
    print(f"{failed} failed; oracles without a query: {sorted(unknown)}")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
