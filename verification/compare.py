"""Run queries beside their SQL and report the ones that differ.

Usage: python -m verification.compare SF_DIR [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.registry import REGISTRY


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    frame = REGISTRY[name](spark, sf_dir)
    actual = [tuple(row) for row in frame.collect()]
    result = connection.execute(ORACLES[name])
    columns = [item[0] for item in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} instead of {sorted(columns)}"]
    left, right = rows_of(frame.columns, actual), rows_of(columns, expected)
    return [f"only in query: {r}" for r in (left - right)] + [f"only in SQL: {r}" for r in (right - left)]


def main(sf_dir: str, *names: str) -> int:
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    spark = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(sf_dir)
    failed = 0
    for name in names or sorted(REGISTRY):
        started = time.time()
        if name not in ORACLES:
            print(f"-- {name}: no SQL, {REGISTRY[name](spark, sf_dir).count()} rows")
            continue
        try:
            differences = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            differences = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(differences)
        print(f"-- {name}: {'ok' if not differences else 'DIFFERS'} in {time.time() - started:.1f} s")
        for line in differences[:6]:
            print(f"     {line}")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
