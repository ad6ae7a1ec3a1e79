"""The join of a large table with a keyed one: which keys are spread, and what is copied."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelspan.operators import lookup as module
from panelspan.operators.lookup import hot_keys, lookup
from tests.helpers import executed_plan, rows


def crowded(spark, n=24_000, odd=True):
    """One key in a third of the rows, one in a sixth, null in a twelfth, the rest spread out."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 6 == 1, "warm")
        .when(F.lit(odd) & (F.col("id") % 12 == 2), None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 1000))
    )
    return spark.range(n).select(key.alias("odd`name"), F.col("id").alias("row"))


def keyed(spark):
    names = ["hot", "warm", None, "absent", *[f"k{i}" for i in range(0, 1000, 2)]]
    return spark.createDataFrame([(x, f"v{x}") for x in names], "`odd``name` string, v string")


def code(spark, text):
    return spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]


def test_the_sketch_finds_hot_keys_and_how_many_shares_they_hold(spark):
    found = hot_keys(crowded(spark), "odd`name", partitions=12)
    assert (found.rows, found.share) == (24_000, 2_000)
    # The twelfth that is null is exactly one share.
    assert found.salts == {code(spark, "hot"): 16, code(spark, "warm"): 8}


def test_evenly_spread_keys_are_not_hot(spark):
    even = spark.range(10_000).select((F.col("id") % 5000).alias("k"))
    assert hot_keys(even, "k", partitions=8).salts == {}
    assert hot_keys(even.limit(0), "k", partitions=8).salts == {}


def test_only_hot_keys_are_copied(spark):
    source = keyed(spark)
    salts = {code(spark, "hot"): 4, code(spark, "warm"): 2}
    copies = module._copied(source, "odd`name", salts).collect()
    count = Counter(r["odd`name"] for r in copies)
    assert count.pop("hot") == 4 and count.pop("warm") == 2
    assert set(count.values()) == {1} and len(copies) == source.count() + 3 + 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("few", [True, False])
def test_every_kind_of_join_gives_each_row_its_key_once(spark, how, few):
    large, small = crowded(spark, 2400), keyed(spark)
    if few:
        small = small.filter("`odd``name` LIKE 'k1%'")
    expected = large.join(small, "odd`name", how)
    found = lookup(large, small, "odd`name", how, False, spread_by=["row"])
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)
    assert rows(lookup(large, small, "odd`name", how, True, spread_by=["row"])) == rows(expected)


def test_no_partition_gets_much_more_than_its_share(spark):
    large, small = crowded(spark, 48_000, odd=False), keyed(spark)
    for name, value in {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }.items():
        spark.conf.set(name, value)
    try:
        found = lookup(large, small, "odd`name", "left", False, spread_by=["row"])
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        plain = large.join(small.hint("shuffle_merge"), "odd`name", "left")
        alone = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == sum(alone) == 48_000
    assert max(alone) >= 16_000 and max(sizes) <= 2.2 * 48_000 / 16


def test_the_plan_moves_each_side_once_and_counts_in_the_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = lookup(crowded(spark), keyed(spark), "odd`name", "inner", False, spread_by=["row"])
    text = executed_plan(found).split("== Initial Plan ==")[0]
    assert text.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("rows_", [1, 3_000, 100_000])
def test_a_bitmap_of_keys_rules_out_most_others_and_none_of_its_own(spark, rows_):
    """Made for fewer keys than there are it rules out less, but never a key it has."""
    listed = spark.range(0, 9_000, 3).select(F.col("id").cast("string").alias("k`"))
    every = spark.range(90_000).select(F.col("id").cast("string").alias("k`"), "id")
    every = every.union(spark.sql("SELECT CAST(null AS STRING), -1L"))
    bitmap = module.listed_bits(listed, "k`", rows_)
    kept = module.maybe_listed(every, "k`", bitmap)
    assert kept.columns == every.columns
    ids = {r["id"] for r in kept.collect()}
    assert set(range(0, 9_000, 3)) <= ids
    if rows_ >= 3_000:
        assert len(ids) < 3_000 + 0.1 * 87_000
    assert "Exchange hashpartitioning" not in executed_plan(kept).split("BroadcastExchange")[0]


def test_an_empty_list_keeps_nothing(spark):
    listed = spark.createDataFrame([(None,)], "k string")
    bitmap = module.listed_bits(listed, "k", 0)
    assert module.maybe_listed(spark.range(5).selectExpr("cast(id AS string) AS k"), "k", bitmap).collect() == []
