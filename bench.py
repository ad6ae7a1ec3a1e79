"""Time the queries and print one JSON line.

Each query runs whole, jobs of its own included, into a sink that discards the
rows. The first run warms up and is not counted; the better of the next two is. Where a
choice can be turned off, the query with it off follows: ``*_shuffled`` do without the
broadcast, ``panel_scan`` reads the text that ``panel_scan_native`` has as numbers,
``*_two_exchanges`` are Spark's own pivot of the same rows.

``BENCH_WIDE=1`` adds the widest shapes, once each: at sf0.1 they have 16,002 columns, or six
times 2,700 by topic, and take one to three minutes each.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import panelspan as ps
from checks import fixtures as fx
from checks.compare import session
from checks.queries import QUERIES, long, sales_long, staged

# These read another output of a job that job_long or job_catalog_long runs.
SAME_JOB = (
    "job_series_wide", "job_period_wide", "job_dimension", "job_catalog_dimension",
    "job_catalog_series_wide", "job_catalog_period_wide",
)


def single_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The widest shape itself, all series in one table."""
    return ps.pivot_series(staged(sales_long(spark, sf_dir)), fx.ORDERS)


def shapes_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cells in one table per topic; all but the last are written here."""
    *others, last = ps.pivot_series_by_topic(
        staged(sales_long(spark, sf_dir)), fx.ORDERS
    ).values()
    for shape in others:
        shape.write.format("noop").mode("overwrite").save()
    return last


def _two_exchanges(panel: DataFrame, keys: list[str], header: str) -> DataFrame:
    headers = ps.pivot_headers(panel, header)
    return panel.groupBy(*keys).pivot(header, headers).agg(F.first(fx.ORDERS.value))


def series_wide_two_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = long(spark, sf_dir)
    return _two_exchanges(panel, fx.ORDERS.series_shape_keys(panel), fx.ORDERS.series_name)


def period_wide_catalog_two_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = sales_long(spark, sf_dir)
    return _two_exchanges(panel, fx.ORDERS.period_shape_keys(panel), fx.ORDERS.period)


WIDE = {query.__name__: query for query in (single_shape, shapes_by_topic)}
WIDEST = (
    "series_wide_catalog", "series_wide_topics", "job_catalog_long", "job_catalog_long_shuffled",
    "job_catalog_series_topics",
)
SPARKS_OWN = {
    query.__name__: query
    for query in (series_wide_two_exchanges, period_wide_catalog_two_exchanges)
}
HEADLINES = {
    name: query for name, query in QUERIES.items() if name not in SAME_JOB + WIDEST
} | SPARKS_OWN


def seconds(
    query: Callable[[SparkSession, str], DataFrame], spark, sf_dir: str, runs: int = 3
) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:] or times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed = {name: seconds(query, spark, sf_dir) for name, query in HEADLINES.items()}
    wide = WIDE if os.environ.get("BENCH_WIDE") else {}
    timed |= {name: seconds(query, spark, sf_dir, runs=1) for name, query in wide.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
