"""Pivots: shapes, headers, duplicate cells, plans, round trips."""

from functools import partial

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import panelspan as ps
from panelspan.sinks.scratch import staged
from tests.helpers import TOPICAL, executed_plan, long, plan, records, rows, topical

PANEL = [
    ("A-land", "AAA", "Births", "b", 2021, 1.0),
    ("A-land", "AAA", "Deaths", "d", 2020, 2.0),
    ("A-land", "AAA", "Births", "b", 2020, 3.0),
    ("B-land", "BBB", "Deaths", "d", 2020, 4.0),
]


def test_one_column_per_series(spark):
    wide = ps.pivot_series(long(spark, *PANEL))
    assert wide.columns == ["Country Name", "Country Code", "Year", "Births", "Deaths"]
    assert {t for _, t in wide.dtypes[3:]} == {"double"}
    assert rows(wide) == [
        ("A-land", "AAA", 2020, 3.0, 2.0),
        ("A-land", "AAA", 2021, 1.0, None),
        ("B-land", "BBB", 2020, None, 4.0),
    ]


def test_one_column_per_period(spark):
    wide = ps.pivot_period(long(spark, *PANEL))
    assert wide.columns == [
        "Country Name", "Country Code", "Series Name", "Series Code", "2020", "2021",
    ]
    assert rows(wide) == [
        ("A-land", "AAA", "Births", "b", 3.0, 1.0),
        ("A-land", "AAA", "Deaths", "d", 2.0, None),
        ("B-land", "BBB", "Deaths", "d", 4.0, None),
    ]


def test_topic_is_part_of_the_row_key_when_present(spark):
    panel = topical(
        spark,
        ("A-land", "AAA", "Births", "b", 2020, 1.0, "Health"),
        ("A-land", "AAA", "Exports", "x", 2020, 2.0, "Trade"),
    )
    assert rows(ps.pivot_series(panel)) == [
        ("A-land", "AAA", 2020, "Health", 1.0, None),
        ("A-land", "AAA", 2020, "Trade", None, 2.0),
    ]
    assert ps.pivot_period(panel).columns[4:] == ["Topic", "2020"]


def test_one_series_name_in_two_topics_shares_a_column(spark):
    panel = topical(
        spark,
        ("L", "A", "Rate", "r1", 2020, 1.0, "Health"),
        ("L", "A", "Rate", "r2", 2020, 2.0, "Trade"),
    )
    assert rows(ps.pivot_series(panel)) == [
        ("L", "A", 2020, "Health", 1.0), ("L", "A", 2020, "Trade", 2.0),
    ]


def test_two_spellings_of_an_entity_give_two_rows(spark):
    panel = long(spark, ("L", "A", "S", "s", 2020, 1.0), ("L.", "A", "S", "s", 2020, 2.0))
    assert ps.pivot_series(panel).count() == 2


def test_null_cells_look_like_absent_ones(spark):
    panel = long(
        spark, ("L", "A", "S", "s", 2020, None), ("L", "A", "S", "s", 2021, 1.0),
        ("M", "B", "S", "s", 2021, 2.0),
    )
    assert rows(ps.pivot_period(panel)) == [
        ("L", "A", "S", "s", None, 1.0), ("M", "B", "S", "s", None, 2.0),
    ]


@pytest.mark.parametrize("second", [1.0, 9.0, None])
def test_duplicate_cells_raise(spark, second):
    panel = long(spark, PANEL[0], (*PANEL[0][:5], second), PANEL[1])
    for wide in (ps.pivot_series(panel), ps.pivot_period(panel)):
        with pytest.raises(PySparkException, match="DUPLICATE_CELL"):
            wide.collect()


def test_duplicates_under_null_keys_count(spark):
    panel = long(spark, ("L", None, "S", "s", 2020, 1.0), ("L", None, "S", "s", 2020, 2.0))
    assert rows(ps.duplicate_period_cells(panel)) == [("L", None, "S", "s", 2020, 2)]
    with pytest.raises(PySparkException, match="DUPLICATE_CELL"):
        ps.pivot_period(panel).collect()


def test_two_codes_under_one_name_collide_by_series_only(spark):
    panel = long(spark, ("L", "A", "S", "s1", 2020, 1.0), ("L", "A", "S", "s2", 2020, 2.0))
    assert ps.duplicate_series_cells(panel).count() == 1
    assert ps.duplicate_period_cells(panel).isEmpty()
    assert ps.pivot_period(panel).count() == 2


def test_assert_unique(spark):
    panel = long(spark, *PANEL)
    ps.assert_unique(panel, ["Country Code", "Series Code", "Year"])
    with pytest.raises(ps.DuplicateCells, match="Country Code, Year"):
        ps.assert_unique(panel, ["Country Code", "Year"])


def test_empty_panel_has_the_key_columns(spark):
    assert ps.pivot_series(long(spark)).columns == ["Country Name", "Country Code", "Year"]
    assert ps.pivot_period(long(spark)).count() == 0


def test_headers_with_dots_and_backticks(spark):
    panel = long(spark, ("L", "A", "a.b", "s", 2020, 1.0), ("L", "A", "c`d", "t", 2020, 2.0))
    assert records(ps.pivot_series(panel)) == [
        {"Country Name": "L", "Country Code": "A", "Year": 2020, "a.b": 1.0, "c`d": 2.0}
    ]


@pytest.mark.parametrize("names", [("Rate", "rate"), ("Year", "x"), ("country name", "x")])
def test_colliding_headers_raise(spark, names):
    panel = long(spark, *[("L", "A", n, n, 2020, 1.0) for n in names])
    with pytest.raises(ps.InvalidHeaders, match="collide"):
        ps.pivot_series(panel)


def test_case_may_tell_headers_apart(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    panel = long(spark, *[("L", "A", n, n, 2020, 1.0) for n in ("Rate", "rate")])
    assert ps.pivot_series(panel).columns[3:] == ["Rate", "rate"]


def test_null_headers_raise(spark):
    with pytest.raises(ps.InvalidHeaders, match="null"):
        ps.pivot_period(long(spark, ("L", "A", "S", "s", None, 1.0)))


def test_headers_have_a_bound_only_where_one_is_asked_for(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    panel = long(spark, *PANEL)
    assert ps.pivot_period(panel).columns[4:] == ["2020", "2021"]
    assert ps.pivot_headers(panel, "Year", max_headers=2) == [2020, 2021]
    with pytest.raises(ps.InvalidHeaders, match="max_headers"):
        ps.pivot_period(panel, max_headers=1)
    with pytest.raises(ps.InvalidHeaders, match="max_headers"):
        ps.pivot_headers(panel, "Series Name", max_headers=1)


def test_more_headers_than_spark_finds_by_itself(spark):
    n = 10_050
    values = [("L", "A", f"s{i}", f"c{i}", 2020, float(i)) for i in range(n)]
    wide = ps.pivot_series(long(spark, *values))
    assert len(wide.columns) == n + 3
    row = wide.first()
    assert (row["s0"], row["s10049"]) == (0.0, 10049.0)


def test_given_headers_need_no_job(spark):
    wide = ps.pivot_period(long(spark, *PANEL), headers=[2021, 2020])
    assert wide.columns[4:] == ["2021", "2020"]
    assert rows(wide)[0] == ("A-land", "AAA", "Births", "b", 1.0, 3.0)


@pytest.mark.parametrize("header", [2020, None])
def test_an_observation_under_an_unlisted_header_raises(spark, header):
    panel = long(spark, PANEL[0], (*PANEL[1][:4], header, 2.0))
    with pytest.raises(PySparkException, match="UNLISTED_HEADER"):
        ps.pivot_period(panel, headers=[2021]).collect()
    with pytest.raises(ps.InvalidHeaders, match="empty"):
        ps.pivot_period(panel, headers=[])


def test_only_narrow_rows_are_shuffled_and_only_once(spark):
    panel = long(spark, *PANEL)
    for wide in (ps.pivot_period(panel), ps.pivot_series(panel, partitions=3)):
        checked = executed_plan(wide).split("Initial Plan")[-1]
        assert checked.count("Exchange hashpartitioning") == 1
        assert checked.index("pivotfirst") < checked.index("REPARTITION_BY_")
    assert rows(ps.pivot_period(panel, partitions=3)) == rows(ps.pivot_period(panel))


def test_headers_of_several_columns_come_from_one_pass(spark):
    from panelspan.operators.reshape import shape_headers

    panel = long(spark, *PANEL)
    assert shape_headers(panel, ["Series Name", "Year"]) == {
        "Series Name": ["Births", "Deaths"], "Year": [2020, 2021],
    }
    assert shape_headers(long(spark), ["Series Name", "Year"]) == {"Series Name": [], "Year": []}


cells = st.dictionaries(
    st.tuples(
        st.sampled_from(["A", "B", None]),
        st.sampled_from(["s1", "s2", "s3"]),
        st.integers(2000, 2004),
    ),
    st.one_of(st.integers(-5, 5).map(float), st.just(float("inf"))),
    min_size=1,
    max_size=30,
)


@hypothesis_settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(cells=cells)
def test_both_shapes_unpivot_to_the_panel(spark, cells):
    values = [
        ("Land", code, f"Series {s}", s, y, v, "T") for (code, s, y), v in cells.items()
    ]
    panel = spark.createDataFrame(values, TOPICAL)
    code = F.replace(F.col("Series Name"), F.lit("Series "), F.lit(""))
    series = ps.pivot_series(panel)
    from_series = (
        series.unpivot(series.columns[:4], series.columns[4:], "Series Name", "Value")
        .filter("Value IS NOT NULL")
        .withColumn("Series Code", code)
        .select(panel.columns)
    )
    period = ps.pivot_period(panel)
    from_period = (
        period.unpivot(period.columns[:5], period.columns[5:], "Year", "Value")
        .filter("Value IS NOT NULL")
        .withColumn("Year", F.col("Year").cast("int"))
        .select(panel.columns)
    )
    assert rows(from_series) == rows(from_period) == rows(panel)


TOPICS = [
    ("A", "AAA", "Births", "b", 2020, 1.0, "Health"),
    ("A", "AAA", "Exports", "x", 2020, 2.0, "Trade"),
    ("A", "AAA", "Deaths", "d", 2021, 3.0, "Health"),
    ("B", "BBB", "Births", "b", 2021, None, "Health"),
    ("B", "BBB", "Rate", "r1", 2020, 5.0, "Trade"),
    ("B", "BBB", "Rate", "r2", 2020, 6.0, "Health"),
]


def test_each_topic_has_its_own_columns(spark):
    shapes = ps.pivot_series_by_topic(topical(spark, *TOPICS))
    keys = ["Country Name", "Country Code", "Year", "Topic"]
    assert list(shapes) == ["Health", "Trade"]
    assert shapes["Health"].columns == [*keys, "Births", "Deaths", "Rate"]
    assert shapes["Trade"].columns == [*keys, "Exports", "Rate"]
    assert rows(shapes["Health"]) == [
        ("A", "AAA", 2020, "Health", 1.0, None, None),
        ("A", "AAA", 2021, "Health", None, 3.0, None),
        ("B", "BBB", 2020, "Health", None, None, 6.0),
        ("B", "BBB", 2021, "Health", None, None, None),
    ]
    assert rows(shapes["Trade"]) == [
        ("A", "AAA", 2020, "Trade", 2.0, None), ("B", "BBB", 2020, "Trade", None, 5.0),
    ]


@pytest.mark.parametrize("partitions", [None, 1, 40])
def test_shapes_by_topic_are_the_single_shape_without_empty_columns(spark, partitions):
    listed = [
        (f"E{e}", f"C{e}", f"S{s}`.{s}", f"s{s}", 2000 + y, float(e * s + y), f"T {s % 4}/é")
        for e in range(9) for s in range(23) for y in range(5) if (e + s + y) % 3
    ]
    panel = topical(spark, *listed)
    whole = ps.pivot_series(panel)
    shapes = ps.pivot_series_by_topic(panel, partitions=partitions)
    for topic, shape in shapes.items():
        assert len(shape.columns) == 4 + len(range(int(topic[2]), 23, 4))
        same = whole.filter(F.col("Topic") == topic).select(
            [F.col("`" + c.replace("`", "``") + "`") for c in shape.columns]
        )
        assert rows(shape) == rows(same)


def test_one_exchange_of_cells_feeds_all_topics(spark):
    plans = []

    def stage(df, partition_by):
        plans.append(executed_plan(df))
        from panelspan.sinks.scratch import staged

        return staged(df, partition_by)

    shapes = ps.pivot_series_by_topic(topical(spark, *TOPICS), stage=stage)
    (made,) = plans
    made = made.split("== Initial Plan ==")[0]
    assert made.count("Exchange hashpartitioning") == 1
    for shape in shapes.values():
        text = executed_plan(shape)
        assert "Exchange" not in text and "PartitionFilters: [isnotnull(_shape" in text


def test_by_topic_raises_on_bad_panels(spark):
    with pytest.raises(PySparkException, match="DUPLICATE_CELL"):
        ps.pivot_series_by_topic(topical(spark, *TOPICS, TOPICS[0]))
    with pytest.raises(ps.InvalidHeaders, match="nulls"):
        ps.pivot_series_by_topic(topical(spark, *TOPICS, ("A", "A", "S", "s", 2020, 1.0, None)))
    with pytest.raises(ps.InvalidHeaders, match="collide"):
        ps.pivot_series_by_topic(topical(spark, *TOPICS, ("A", "A", "births", "s", 2020, 1.0, "Health")))
    with pytest.raises(ps.InvalidHeaders, match="more than 4"):
        ps.pivot_series_by_topic(topical(spark, *TOPICS), max_headers=4)
    with pytest.raises(ps.InvalidHeaders, match="no column"):
        ps.pivot_series_by_topic(long(spark, *PANEL))
    # Names that collide in different topics are no trouble.
    apart = topical(spark, *TOPICS, ("A", "A", "births", "s", 2020, 1.0, "Trade"))
    assert len(ps.pivot_series_by_topic(apart, max_headers=6)["Trade"].columns) == 7
    assert ps.pivot_series_by_topic(topical(spark).limit(0)) == {}


def moved(df):
    """Rows and bytes written by the exchanges of a query that has run."""
    df.collect()
    found = [0, 0]

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            found[0] += node.metrics().apply("shuffleRecordsWritten").value()
            found[1] += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_unique_keys_do_not_move(spark):
    """Only keys whose hash repeats are counted as a whole; of a clean panel none are."""
    clean = spark.range(50_000).selectExpr(
        "concat('entity ', id) AS e", "concat('series ', id % 97) AS s", "id % 50 AS p"
    )
    dirty = clean.union(clean.limit(20)).union(clean.limit(3))
    keys = ["e", "s", "p"]
    assert moved(ps.duplicate_keys(clean, keys)) == [0, 0]
    found = ps.duplicate_keys(dirty, keys)
    assert moved(found)[0] < 200
    assert sorted(r["row_count"] for r in found.collect()) == [2] * 17 + [3] * 3
    # Above the bound on what is listed, all rows are counted by their keys.
    assert rows(ps.duplicate_keys(dirty, keys, most_suspects=19)) == rows(found)
    assert moved(ps.duplicate_keys(dirty, keys, most_suspects=19))[0] > 50_000


def test_keys_that_hash_alike_are_told_apart(spark):
    """A null is skipped by the hash: (null, x) and (x, null) are suspects, no duplicates."""
    panel = spark.createDataFrame([(None, "x"), ("x", None), ("y", "z")], "a string, b string")
    assert ps.duplicate_keys(panel, ["a", "b"]).collect() == []
    again = panel.union(panel.limit(1))
    assert rows(ps.duplicate_keys(again, ["a", "b"])) == [(None, "x", 2)]


MANY = [
    (f"E{e}", f"C{e}", f"S{s:02}`.é", f"s{s}", 2000 + y, float(e * s + y), f"T {s % 3}/é")
    for e in range(5) for s in range(23) for y in range(4) if (e + s + y) % 3
]


def no_columns_of_names(df):
    return df.columns[4:] == ["_block", "0", "1", "2", "3"]


def test_more_series_than_one_table_holds_come_in_blocks_of_columns(spark):
    panel = topical(spark, *MANY, ("Z", "Z", "S01`.é", "s1", 2020, None, "T 1/é"))
    headers = ps.series_blocks(panel, width=4)
    places = [tuple(row)[:3] for row in headers.orderBy("_block", "_column").collect()]
    assert places == [(f"S{s:02}`.é", s // 4, s % 4) for s in range(23)]
    assert headers.agg(F.sum("_observations")).first()[0] == len(MANY) + 1
    wide = ps.pivot_series(panel, headers=headers, partitions=7)
    assert no_columns_of_names(wide)
    keys = wide.columns[:4]
    # One row for each row key and block with observations, a null one among them.
    want = {(*row[:2], row[4], row[6], int(row[2][1:3]) // 4) for row in MANY}
    assert sorted(tuple(r) for r in wide.select(*keys, "_block").collect()) == sorted(
        want | {("Z", "Z", 2020, "T 1/é", 0)}
    )
    cells = ps.series_cells(wide, headers)
    assert rows(cells) == sorted(
        ((r[0], r[1], r[4], r[6], r[2], r[5]) for r in MANY), key=repr
    )


def test_the_number_of_series_decides_between_one_table_and_blocks(spark):
    panel = topical(spark, *MANY)
    few = ps.series_headers(panel, most_columns=23)
    assert few == sorted({row[2] for row in MANY})
    many = ps.series_headers(panel, most_columns=22)
    assert many.count() == 23
    # No schema holds a name: it does not grow with the series.
    assert len(ps.pivot_series(panel, headers=many).columns) == 5 + 23
    assert ps.topic_headers(panel, most_columns=8) is None
    assert ps.topic_headers(panel, most_columns=7).count() == 23


def test_blocks_keep_the_rules_of_one_table(spark):
    panel = topical(spark, *MANY)
    headers = ps.series_blocks(panel, width=4)
    with pytest.raises(PySparkException, match="DUPLICATE_CELL"):
        ps.pivot_series(panel.union(panel.limit(1)), headers=headers).collect()
    other = topical(spark, *MANY, ("A", "A", "Unlisted", "u", 2020, 1.0, "T 1/é"))
    with pytest.raises(PySparkException, match="UNLISTED_HEADER"):
        ps.pivot_series(other, headers=headers).collect()
    alike = topical(spark, *MANY, ("A", "A", "s01`.É", "u", 2020, 1.0, "T 0/é"))
    with pytest.raises(ps.InvalidHeaders, match="collide"):
        ps.series_blocks(alike, width=4)
    assert ps.series_blocks(alike, by_topic=True, width=4).count() == 24
    with pytest.raises(ps.InvalidHeaders, match="collide"):
        ps.series_blocks(topical(spark, ("A", "A", "year", "u", 2020, 1.0, "T")))
    with pytest.raises(ps.InvalidHeaders, match="null"):
        ps.series_blocks(topical(spark, ("A", "A", None, "u", 2020, 1.0, "T")))
    with pytest.raises(ps.InvalidHeaders, match="max_headers"):
        ps.series_blocks(panel, max_headers=22)


def test_topics_with_too_many_series_come_in_blocks(spark):
    shared = ("A", "AAA", "S01`.é", "s1", 2020, 9.0, "T 2/é")
    panel = topical(spark, *MANY, shared)
    headers = ps.series_blocks(panel, by_topic=True, width=4)
    assert headers.columns[:2] == ["Topic", "Series Name"] and headers.count() == 24
    shapes = ps.pivot_series_by_topic(panel, headers=headers)
    assert list(shapes) == ["T 0/é", "T 1/é", "T 2/é"]
    found = []
    for topic, wide in shapes.items():
        assert no_columns_of_names(wide)
        cells = rows(ps.series_cells(wide, headers))
        assert {row[3] for row in cells} == {topic}
        found += cells
    want = [(r[0], r[1], r[4], r[6], r[2], r[5]) for r in [*MANY, shared]]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_a_table_of_names_too_large_to_send_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr("panelspan.operators.reshape.NAMES_BROADCAST_BYTES", 0)
    panel = topical(spark, *MANY)
    headers = ps.series_blocks(panel, width=4)
    cells = ps.series_cells(ps.pivot_series(panel, headers=headers), headers)
    want = [(r[0], r[1], r[4], r[6], r[2], r[5]) for r in MANY]
    assert rows(cells) == sorted(want, key=repr)


def no_sketch(*_):
    raise AssertionError("the cells were computed once more to find keys with many rows")


@pytest.mark.parametrize("hashed", [True, False])
@pytest.mark.parametrize("by_topic", [False, True])
def test_cells_of_blocks_are_computed_once(spark, monkeypatch, hashed, by_topic):
    """The table of names knows which series have many rows: no pass over wide rows does."""
    monkeypatch.setattr("panelspan.operators.reshape.NAMES_BROADCAST_BYTES", 0)
    if not hashed:
        monkeypatch.setattr("panelspan.operators.reshape.NAMES_HASHED_BYTES", -1)
    monkeypatch.setattr("panelspan.operators.lookup.hot_keys", no_sketch)
    crowd = [(f"H{i}", f"H{i}", "S01`.é", "s1", 2020, float(i), "T 1/é") for i in range(300)]
    panel = topical(spark, *MANY, *crowd)
    headers = ps.series_blocks(panel, by_topic=by_topic, width=4)
    cells = ps.series_cells(ps.pivot_series(panel, headers=headers), headers)
    want = [(r[0], r[1], r[4], r[6], r[2], r[5]) for r in [*MANY, *crowd]]
    assert rows(cells) == sorted(want, key=repr)
    joins = [line for line in executed_plan(cells).splitlines() if "Join" in line]
    assert any(("ShuffledHashJoin" if hashed else "SortMergeJoin") in line for line in joins)


def test_keys_with_many_rows_are_known_from_counts(spark):
    from panelspan.operators.lookup import counted_hot_keys, hot_keys

    keys = spark.range(2_000).selectExpr("if(id < 900, 'hot', concat('k', id)) AS k")
    counts = keys.groupBy("k").count()
    found = counted_hot_keys(counts, "k", "count", partitions=10)
    guessed = hot_keys(keys, "k", partitions=10)
    assert (found.rows, found.share) == (guessed.rows, guessed.share) == (2_000, 200)
    assert list(found.salts) == list(guessed.salts) and list(found.salts.values()) == [18]
    assert counted_hot_keys(counts.limit(0), "k", "count", partitions=10).salts == {}


def test_a_block_is_pivoted_by_one_grouping_that_spark_compiles(spark):
    """Beyond 100 fields Spark neither compiles a stage nor reads Parquet in batches."""
    many = [(f"E{e}", "C", f"S{s:03}", "s", 2020, float(s), "T") for e in (1, 2) for s in range(90)]
    panel = topical(spark, *many)
    wide = ps.pivot_series(panel, headers=ps.series_headers(panel, most_columns=50))
    assert len(wide.columns) == 5 + 32
    assert wide.count() == 2 * 3
    assert "pivotfirst" not in plan(wide).lower()
    # One grouping, which Spark does in two steps; its own pivot takes two groupings.
    last = executed_plan(wide).split("== Initial Plan ==")[0]
    assert last.count("HashAggregate(") == 2


@pytest.mark.parametrize("width", [33, 64, 70])
def test_blocks_wider_than_one_number_marks(spark, width):
    series = [("A", "A", f"S{s:03}", "s", 2020, None if s == 40 else float(s), "T") for s in range(70)]
    panel = topical(spark, *series)
    headers = ps.series_blocks(panel, width=width)
    cells = ps.series_cells(ps.pivot_series(panel, headers=headers), headers)
    assert sorted((r["Series Name"], r["Value"]) for r in cells.collect()) == [
        (row[2], row[5]) for row in series if row[5] is not None
    ]
    for again in (0, 31, 32, 40, 63, 69):
        twice = topical(spark, *series, (*series[again][:5], 1.0, "T"))
        with pytest.raises(PySparkException, match="DUPLICATE_CELL"):
            ps.pivot_series(twice, headers=headers).collect()


def test_headers_are_found_in_one_pass(spark):
    """Names are counted once, in a table; few and many come from it."""
    panel = topical(spark, *MANY)
    for of, most in ((ps.series_headers, 22), (ps.topic_headers, 7)):
        tables = []

        def stage(df, partition_by=()):
            tables.append(plan(df))
            return staged(df, partition_by)

        passes = spark.sparkContext.accumulator(0)

        def seen(batches):
            passes.add(1)
            yield from batches

        once = panel.coalesce(1).mapInArrow(seen, panel.schema)
        assert of(once, most_columns=most, stage=stage).count() == 23
        assert passes.value == 1 and len(tables) == 3


def test_topics_in_blocks_meet_the_names_once(spark, monkeypatch):
    from checks import fixtures as fx
    from checks import queries

    names = ["entity_name", "entity_code", "series_name", "series_code", "period", "value", "topic"]
    panel = topical(spark, *MANY).toDF(*names)
    monkeypatch.setattr(queries, "sales_long", lambda *_: panel)
    monkeypatch.setattr(queries.ps, "topic_headers", partial(ps.topic_headers, most_columns=7))
    cells = queries.series_wide_topics(spark, "")
    want = [(r[0], r[1], r[4], r[6], r[2], r[5]) for r in MANY]
    assert rows(cells) == sorted(want, key=repr)
    assert cells.columns == fx.ORDERS.series_shape_keys(panel) + ["series_name", "value"]
    logical = cells._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join Inner") == 1


def test_wide_rows_are_dealt_to_more_tasks_as_they_grow(spark, monkeypatch):
    """What a task holds is bounded by its share of the rows, whatever Spark's setting is."""
    from panelspan.operators.reshape import shape_partitions

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    panel = topical(spark, *MANY)
    keys = ps.PANEL.period_shape_keys(panel)
    assert shape_partitions(panel, keys, 4, len(MANY)) is None
    one_row = 2 * 160 + 4 * 8
    monkeypatch.setattr("panelspan.operators.reshape.WIDE_BYTES_PER_PARTITION", 5 * one_row)
    want = -(-len(MANY) // 5)
    assert want > least and shape_partitions(panel, keys, 4, len(MANY)) == want
    # Where the session's number is enough, adaptive execution does not lower it.
    assert shape_partitions(panel, keys, 4, 6) == least
    wide = ps.pivot_period(panel)
    assert len({r[0] for r in wide.select(F.spark_partition_id()).collect()}) > least
    # With many columns the row keys are counted: far fewer than observations here.
    narrow = shape_partitions(panel, ["Country Code"], 33, len(MANY))
    assert narrow == -(-(len(MANY) * 160 + 5 * (160 + 33 * 8)) // (5 * one_row))
    monkeypatch.undo()
    assert rows(wide) == rows(ps.pivot_period(panel))
