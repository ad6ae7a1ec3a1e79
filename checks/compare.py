"""Run every query and its SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelspan")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(actual: DataFrame, sql: str, connection) -> str | None:
    """Why a result differs from its SQL, or None."""
    relation = connection.execute(sql)
    names = [item[0] for item in relation.description]
    expected = _bag(names, relation.fetchall())
    if sorted(names) != sorted(actual.columns):
        return f"columns {sorted(actual.columns)} != {sorted(names)}"
    found = _bag(actual.columns, actual.collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{found.total()} rows, expected {expected.total()}; "
        f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
    )


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, connection = session(), oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        result = QUERIES[name](spark, sf_dir)
        problem = difference(result, ORACLE[name], connection)
        rows = result.count()
        failed += problem is not None
        print(f"{name:32} {rows:8} {time.perf_counter() - start:6.2f}s {problem or 'ok'}")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
