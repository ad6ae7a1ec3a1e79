"""Entity filters and the salted lookup."""

import pytest

import panelspan as ps
from tests.helpers import executed_plan, long, rows


def with_codes(spark, *codes):
    return long(spark, *[("Land", c, f"S{i}", f"s{i}", 2020, 1.0) for i, c in enumerate(codes)])


def kept(df):
    return sorted(row["Country Code"] for row in df.collect())


def test_aggregates_and_blank_codes_are_dropped(spark):
    panel = with_codes(spark, "ABC", "WLD", " wld ", "", "  ", None, "XKX", "euu", " abd ")
    assert kept(ps.exclude_entities(panel)) == [" abd ", "ABC", "XKX"]


def test_own_list_is_compared_in_the_same_way(spark):
    panel = with_codes(spark, "ABC", " abc", "WLD", "")
    assert kept(ps.exclude_entities(panel, codes=[" abc "])) == ["WLD"]
    assert kept(ps.exclude_entities(panel, codes=[])) == [" abc", "ABC", "WLD"]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_listed_codes(spark, limit):
    panel = with_codes(spark, "ABC", " abc", "WLD", "", None, "XKX")
    codes = spark.createDataFrame([("wld",), (" Abc",), (None,), ("",), ("wld",)], "c string")
    result = ps.exclude_listed_entities(panel, codes, "c", broadcast_bytes=limit)
    assert kept(result) == ["XKX"]
    assert result.columns == panel.columns


def test_listed_codes_may_be_none_at_all(spark):
    panel = with_codes(spark, "ABC", "")
    codes = spark.createDataFrame([], "c string")
    assert kept(ps.exclude_listed_entities(panel, codes, "c", broadcast_bytes=-1)) == ["ABC"]


def test_table_within_the_limit_is_broadcast_and_a_larger_one_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    panel = with_codes(spark, "ABC", "WLD")
    codes = spark.createDataFrame([("WLD",)], "c string")
    assert "BroadcastHashJoin" in executed_plan(ps.exclude_listed_entities(panel, codes, "c"))
    shuffled = ps.exclude_listed_entities(panel, codes, "c", broadcast_bytes=0)
    assert "BroadcastHashJoin" not in executed_plan(shuffled)


def test_observed_only_keeps_zero(spark):
    panel = long(
        spark, ("L", "A", "S", "s", 2020, 0.0), ("L", "A", "S", "s", 2021, None)
    )
    assert rows(ps.observed_only(panel)) == [("L", "A", "S", "s", 2020, 0.0)]
