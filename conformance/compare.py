"""Run queries and their SQL side by side and compare all rows, exactly.

    python -m conformance.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from conformance.oracle import all_oracles
from conformance.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    # Each value with its type, so that 1 and 1.0 or True differ.
    return Counter(tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = all_queries()[name](spark, sf_dir)
    found = _rows(df.columns, df.collect())
    sql = all_oracles().get(name)
    if sql is None:
        return None
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    wanted = _rows(columns, result.fetchall())
    if not wanted:
        return "expected no rows, so the check shows nothing"
    if found != wanted:
        extra, missing = found - wanted, wanted - found
        return (
            f"{sum(found.values())} rows against {sum(wanted.values())}; extra "
            f"{list(extra)[:1]}; missing {list(missing)[:1]}"
        )
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = open_tables(sf_dir), 0
    for name in names or all_queries():
        start = time.time()
        try:
            problem = differences(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return min(failed, 1)


if __name__ == "__main__":
    sys.exit(main())
