"""Run every query and its SQL on one directory of tables and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.registry import queries


def local_spark(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("checks")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duckdb_tables(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(directory).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _sorted_rows(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(row[i] for i in order) for row in map(tuple, rows)) if not any(
        None in tuple(row) for row in rows
    ) else sorted((tuple(row[i] for i in order) for row in map(tuple, rows)), key=repr)


def difference(spark: SparkSession, connection, name: str, directory: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    result = queries()[name](spark, directory)
    found = connection.execute(oracle_sql()[name])
    names = [column[0] for column in found.description]
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    ours = _sorted_rows(result.columns, result.collect())
    theirs = _sorted_rows(names, found.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b or list(map(type, a)) != list(map(type, b))]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else None


def main(directory: str, names: list[str]) -> int:
    spark = local_spark()
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_tables(directory)
    failures = 0
    for name in names or list(queries()):
        started = time.time()
        try:
            problem = difference(spark, connection, name, directory)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - started:.1f}s)", flush=True)
    print(f"{failures} failed")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
