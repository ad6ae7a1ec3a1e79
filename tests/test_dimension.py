"""Dimension cleaning, conflicts, enrichment, used and unmapped keys."""

import pytest
from pyspark.sql import functions as F

import panelspan as ps
from tests.helpers import dimension, executed_plan, full_dimension, long, plan, records, rows

FACTS = [
    ("A-land", "AAA", "One", " s1 ", 2020, 1.0),
    ("A-land", "AAA", "Two", "s2", 2020, 2.0),
    ("A-land", "AAA", "Three", "s3", 2020, None),
    ("B-land", "BBB", "Nine", "s9", 2020, 9.0),
]


def test_pairs_are_trimmed_distinct_and_not_blank(spark):
    source = dimension(
        spark,
        ("s1", "Health"), (" s1 ", " Health "), ("s2", " "), ("s3", None),
        (None, "Lost"), (" ", "Lost"), ("s4", "Trade"),
    )
    assert rows(ps.clean_dimension(source)) == [("s1", "Health"), ("s4", "Trade")]


def test_conflicts_are_listed_and_raise_even_when_unused(spark):
    source = dimension(spark, ("s1", "Health"), ("x", "Low"), (" x", "High"), ("x", "Low "))
    assert rows(ps.dimension_conflicts(source)) == [("x", 2)]
    with pytest.raises(ps.ConflictingTopics):
        ps.enrich(long(spark, *FACTS), source)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_enrich_attaches_topics_and_drops_unmapped_series(spark, limit):
    source = dimension(spark, ("s1", "Health"), (" s2", "Trade "), ("s3", "Trade"), ("u", "Unused"))
    result = ps.enrich(long(spark, *FACTS), source, broadcast_bytes=limit)
    assert result.columns == [*ps.PANEL.columns, "Topic"]
    assert rows(result) == [
        ("A-land", "AAA", "One", "s1", 2020, 1.0, "Health"),
        ("A-land", "AAA", "Three", "s3", 2020, None, "Trade"),
        ("A-land", "AAA", "Two", "s2", 2020, 2.0, "Trade"),
    ]


def test_enrich_with_an_empty_dimension(spark):
    assert rows(ps.enrich(long(spark, *FACTS), dimension(spark))) == []


def test_salted_join_spreads_a_hot_series(spark):
    """One series holds nearly all rows; no shuffle partition may hold nearly all of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    numbers = spark.range(40_000)
    facts = numbers.select(
        F.lit("L").alias("Country Name"),
        F.concat(F.lit("C"), F.col("id") % 500).alias("Country Code"),
        F.lit("Hot").alias("Series Name"),
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("Series Code"),
        (F.lit(1900) + (F.col("id") / 500)).cast("int").alias("Year"),
        F.lit(1.0).alias("Value"),
    )
    source = dimension(spark, ("hot", "H"), ("cold", "C"))
    joined = ps.enrich(facts, source, broadcast_bytes=0)
    assert "_salt" in executed_plan(joined)
    assert joined.count() == 40_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = ps.enrich(facts, source, broadcast_bytes=0)
        sizes = [r["count"] for r in again.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 40_000
    assert max(sizes) < 20_000


def test_grouping_by_series_after_a_shuffled_join_does_not_reuse_its_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = ps.enrich(long(spark, *FACTS), dimension(spark, ("s1", "H")), broadcast_bytes=0)
    grouped = joined.groupBy("Series Code", "Year").count()
    top = executed_plan(grouped).split("SortMergeJoin")[0]
    assert "Exchange hashpartitioning(Series Code" in top


def test_unmapped_series_are_counted(spark):
    source = dimension(spark, ("s1", "Health"), ("s2", " "))
    panel = long(spark, *FACTS, ("C-land", "CCC", "Nine", "s9", 2021, 1.0))
    assert rows(ps.unmapped_series(panel, source)) == [("s2", 1), ("s3", 1), ("s9", 2)]
    assert rows(ps.unmapped_series(panel, source, broadcast_bytes=0)) == [
        ("s2", 1), ("s3", 1), ("s9", 2),
    ]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_used_dimension_keeps_copies_and_matches_trimmed_keys(spark, limit):
    source = full_dimension(
        spark, (" s1", "Health"), ("s1", " "), ("s2", "Trade"), ("s2", "Trade"), ("u", "Unused"),
        (None, "Lost"),
    )
    final = ps.canonicalize(long(spark, *FACTS))
    result = ps.used_dimension(source, final, broadcast_bytes=limit)
    assert result.columns == list(ps.DIMENSION.published)
    assert [(r["id"], r["name"], r["topic"]) for r in records(result)] == [
        ("s1", "name of  s1", "Health"),
        ("s1", "name of s1", " "),
        ("s2", "name of s2", "Trade"),
        ("s2", "name of s2", "Trade"),
    ]


def test_used_dimension_needs_all_published_columns(spark):
    with pytest.raises(ps.MissingColumns, match="name, source_id, source, source_organization"):
        ps.used_dimension(dimension(spark, ("a", "b")), long(spark, *FACTS))


def test_load_dimension_reads_quotes_commas_and_line_breaks_as_text(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('id,topic,n\ns1,"He said ""hi"", twice\nthen left",007\n s2 ,,\n')
    result = ps.load_dimension(spark, path)
    assert {t for _, t in result.dtypes} == {"string"}
    assert rows(result) == [
        (" s2 ", None, None), ("s1", 'He said "hi", twice\nthen left', "007"),
    ]
    assert rows(ps.load_dimension(spark, path, columns=["id", "topic", "n"])) == rows(result)


def test_load_dimension_needs_key_and_topic(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("id,theme\ns1,x\n")
    with pytest.raises(ps.MissingColumns, match="topic"):
        ps.load_dimension(spark, path)


@pytest.mark.parametrize("shape", ["long", "period_wide"])
def test_adaptive_execution_may_split_a_hot_series(spark, tmp_path, shape):
    """Also when the join is followed by a grouping that could have used its partitions."""
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    number = F.col("id")
    facts = spark.range(0, 30_000, 1, 6).select(
        F.lit("L").alias("Country Name"),
        F.concat(F.lit("C"), number % 3000).alias("Country Code"),
        F.lit("Hot").alias("Series Name"),
        F.when(number % 50 == 0, F.concat(F.lit("s"), number)).otherwise("hot").alias("Series Code"),
        (F.lit(1900) + (number / 3000)).cast("int").alias("Year"),
        number.cast("double").alias("Value"),
    )
    facts.write.parquet(f"{tmp_path}/facts")
    source = spark.range(0, 30_000, 50).select(
        F.concat(F.lit("s"), number).alias("id"), F.lit("T").alias("topic")
    ).unionAll(dimension(spark, ("hot", "H")))
    panel = spark.read.parquet(f"{tmp_path}/facts")
    # Two salts leave the hot series' partitions large, as a real one would be.
    pairs = ps.clean_dimension(source)
    from panelspan.operators.lookup import lookup

    joined = lookup(
        panel, pairs, "Series Code", "inner", False, ["Country Code", "Year"], salts=2
    )
    if shape == "period_wide":
        joined = ps.pivot_period(joined, headers=list(range(1900, 1910)))
    result = joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final
    cells = sum(v is not None for r in result for v in r[5:]) if shape != "long" else len(result)
    assert cells == 30_000


@pytest.mark.parametrize("limit", [10**6, 0])
def test_used_dimension_moves_no_panel_row_before_it_is_aggregated(spark, tmp_path, limit):
    facts = long(spark, *[("L", f"C{i}", "S", f"s{i % 3}", 2020, 1.0) for i in range(300)])
    facts.write.parquet(f"{tmp_path}/facts")
    source = full_dimension(spark, ("s1", "T"), (" s2 ", "T"), ("s9", "T"))
    used = ps.used_dimension(
        source, spark.read.parquet(f"{tmp_path}/facts"), broadcast_bytes=limit
    )
    assert sorted(r["id"] for r in used.collect()) == ["s1", "s2"]
    lines = plan(used).split("== Physical Plan ==")[-1].splitlines()
    # The panel is the only file; its location may be cut off in the plan's text.
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "Series Code" in x)
    above = [x for x in lines[:scan] if "Exchange" in x or "HashAggregate" in x]
    assert "HashAggregate" in above[-1] and "partial" not in above[-2]


def test_one_grouping_finds_topics_and_conflicts(spark):
    source = dimension(spark, ("a", "T"), (" a ", " T "), ("b", "U"), ("b", "V"), ("c", None))
    found = ps.topic_by_code(source)
    assert rows(found) == [("a", "T", False), ("b", "U", True)]
    with pytest.raises(ps.ConflictingTopics, match="1 series"):
        ps.assert_no_conflicts(found)
    assert ps.assert_no_conflicts(found.filter("`Series Code` = 'a'")).rows == 1


def test_dimension_rows_that_are_not_used_do_not_move(spark):
    """Beyond the broadcast limit: a dimension of 20,000 rows, of which 50 are used."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    wide = spark.range(20_000).select(
        F.concat(F.lit(" s"), F.col("id").cast("string")).alias("id"),
        *[F.concat(F.lit(name), "id").alias(name) for name in ps.DIMENSION.published[1:]],
    )
    facts = spark.range(5_000).select(
        F.lit("L").alias("Country Name"), F.lit("C").alias("Country Code"),
        F.lit("S").alias("Series Name"),
        F.concat(F.lit("s"), (F.col("id") % 50 * 7).cast("string")).alias("Series Code"),
        F.col("id").cast("int").alias("Year"), F.lit(1.0).alias("Value"),
    )
    used = ps.used_dimension(wide, facts, broadcast_bytes=0)
    assert {r["id"] for r in used.collect()} == {f"s{i * 7}" for i in range(50)}
    plans = executed_plan(used).split("== Initial Plan ==")[0]
    # The whole rows are exchanged after the bitmap has been asked.
    top = next(part for part in plans.split("Exchange hashpartitioning") if "getbit" in part)
    assert "FileScan" not in plans and "BroadcastHashJoin" in top
    from tests.test_reshape import moved

    # Codes once for each task, and the used rows: none of the 20,000 others.
    assert moved(used)[0] < 2_000
