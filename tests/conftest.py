import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    yield spark
    spark.stop()


@pytest.fixture(autouse=True)
def settings(spark):
    """Undo what a test sets on the session."""
    names = (
        "spark.sql.pivotMaxValues",
        "spark.sql.caseSensitive",
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    yield
    for name in names:
        spark.conf.unset(name)
