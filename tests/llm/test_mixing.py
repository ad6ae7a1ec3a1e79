import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelspan.llm.mixing import poisson_mix
from tests.llm.messy import as_rows, empty, messy


def identity(*values):
    """A row's hash: of the hashes of its values as text."""
    each = ["-" if v is None else hashlib.md5(str(v).encode()).hexdigest() for v in values]
    return hashlib.md5("|".join(each).encode()).hexdigest()


def unit(*parts):
    digest = hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    return int(digest[:13], 16) / 2**52


def draw(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def rows_of(spark, *counts):
    listed, at = [], 0
    for source, n in counts:
        listed += [(at + i, source) for i in range(n)]
        at += n
    return spark.createDataFrame(listed, "doc_id long, source string")


def test_copies_invert_the_distribution_at_the_hash(spark):
    source = rows_of(spark, ("a", 300), ("b", 60), (None, 20))
    found = poisson_mix(source, weights={"a": 1, "b": 2, None: 1}, rows=400, seed=5)
    rate = {"a": 100 / 300, "b": 200 / 60, None: 100 / 20}
    expected = Counter()
    for row in source.collect():
        n = draw(rate[row["source"]], unit(5, identity(*row), 1, "draw", 1))
        if n:
            expected[row["doc_id"]] = n
    assert Counter(r["doc_id"] for r in found.collect()) == expected
    assert all(1 <= r["copy"] <= r["copies"] for r in found.collect())
    assert len({(r["doc_id"], r["copy"]) for r in found.collect()}) == found.count()


def test_large_rates_are_sums_of_draws(spark):
    source = rows_of(spark, ("a", 40), ("b", 4000))
    found = poisson_mix(source, weights={"a": 1, "b": 1}, rows=8000, seed=1)
    total = Counter(r["source"] for r in found.collect())
    assert abs(total["a"] - 4000) < 5 * math.sqrt(4000)
    one = [r for r in found.collect() if r["doc_id"] == 3]
    draws = math.ceil(100 / 32)
    assert len(one) == sum(
        draw(100 / draws, unit(1, identity(3, "a"), 1, "draw", i)) for i in range(1, draws + 1)
    )


def test_rows_are_shuffled_by_their_key(spark):
    source = rows_of(spark, ("a", 500))
    found = poisson_mix(source, seed=2)
    keys = [r["shuffle_key"] for r in found.coalesce(1).sortWithinPartitions("shuffle_key").collect()]
    assert keys == sorted(keys)
    ids = [r["doc_id"] for r in found.orderBy("shuffle_key").collect()]
    assert ids != sorted(ids)
    again = poisson_mix(source.repartition(5), seed=2)
    assert as_rows(found, "doc_id", "copy", "shuffle_key") == as_rows(
        again, "doc_id", "copy", "shuffle_key"
    )


def test_unnamed_sources_get_none_and_zero_weights_give_no_rows(spark):
    source = rows_of(spark, ("a", 50), ("b", 50))
    assert {r["source"] for r in poisson_mix(source, weights={"a": 1}).collect()} == {"a"}
    assert poisson_mix(source, weights={"a": 0}).collect() == []
    with pytest.raises(ValueError):
        poisson_mix(source, weights={"a": -1})


def test_messy_and_empty_tables(spark):
    assert poisson_mix(empty(spark)).collect() == []
    found = poisson_mix(messy(spark), rows=200, seed=3)
    rows = found.collect()
    assert {r["source"] for r in rows} == {"s", None}
    assert {r["doc_id"] for r in rows} == {None, *range(1, 11)}
    assert all(1 <= r["copy"] <= r["copies"] for r in rows)


def test_rows_without_a_key_are_drawn_each_on_their_own(spark):
    """3,000 equal rows of one source: whatever the seed, none is lost as a whole."""
    rows = [(None, "t", "a")] * 3000 + [(i, "t", "b") for i in range(1000)]
    source = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = 4000 * 3000**0.5 / (3000**0.5 + 1000**0.5)
    for seed in range(20):
        found = poisson_mix(source, seed=seed)
        n = found.filter("source = 'a'").count()
        assert abs(n - wanted) < 0.05 * wanted + 2 * wanted**0.5
    expected = Counter()
    rate = wanted / 3000
    for i in range(1, 3001):
        expected[draw(rate, unit(19, identity(*rows[0]), i, "draw", 1))] += 1
    drawn = Counter(r["copies"] for r in found.filter("source = 'a' AND copy = 1").collect())
    assert drawn == {k: n for k, n in expected.items() if k}


def test_copies_of_one_row_are_spread_over_all_tasks(spark):
    source = spark.createDataFrame([(1, "t", "a")] * 4000, "doc_id long, text string, source string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = poisson_mix(source, seed=1)
        parts = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(parts) == 8 and max(r["count"] for r in parts) < 2 * 4000 / 8
