"""Every registered query against its SQL, over whole tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from checks.compare import difference, oracle_connection
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.helpers import plan

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    with oracle_connection(SF_DIR) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    result = QUERIES[name](spark, SF_DIR)
    assert difference(result, ORACLE[name], connection) is None
    assert not re.search("Python|Pandas|CartesianProduct|NestedLoop", plan(result))


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert not result.isEmpty()
    assert result.columns[:5] == [
        "entity_name", "entity_code", "series_name", "series_code", "topic",
    ]
