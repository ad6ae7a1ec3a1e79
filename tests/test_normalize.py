"""Canonical projection and quality rules."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import panelspan as ps
from tests.helpers import LONG, RAW, plan, raw, records, rows

GOOD = ("Land", "LND", "Births", "B.1", "2020", "1.5")


def changed(**cells):
    names = ["entity", "code", "series", "series_code", "year", "value"]
    return tuple(cells.get(name, GOOD[i]) for i, name in enumerate(names))


def report(df, spec=ps.PANEL):
    return ps.quality_report(df, spec).first().asDict()


def test_text_is_trimmed_and_typed_in_fixed_order(spark):
    source = raw(spark, ("  Land ", " lnd ", " Births", "B.1 ", " 2020 ", " 1e3 "))
    source = source.withColumns({"extra": source["Year"]}).select(
        "extra", "Value", "Year", "Series Code", "Series Name", "Country Code", "Country Name"
    )
    result = ps.canonicalize(source)
    assert result.columns == ps.PANEL.columns
    assert [t for _, t in result.dtypes] == ["string"] * 4 + ["int", "double"]
    assert rows(result) == [("Land", "lnd", "Births", "B.1", 2020, 1000.0)]


def test_only_spaces_are_trimmed(spark):
    result = ps.canonicalize(raw(spark, changed(entity="\tLand  ")))
    assert rows(result)[0][0] == "\tLand "


@pytest.mark.parametrize("blank", [None, "", "   "])
def test_blank_value_is_accepted_as_null(spark, blank):
    source = raw(spark, changed(value=blank))
    ps.assert_clean(report(source))
    assert rows(ps.canonicalize(source))[0][5] is None


@pytest.mark.parametrize("text", ["NaN", "Infinity", "1e3", "1.5d", "-2", "1.5f", " 7 "])
def test_numeric_texts(spark, text):
    source = raw(spark, changed(value=text))
    ps.assert_clean(report(source))
    assert rows(ps.canonicalize(source))[0][5] is not None


@pytest.mark.parametrize("text", ["abc", "0x10", "1,000", "1 2"])
def test_other_texts_are_rejected(spark, text):
    with pytest.raises(ps.InvalidRows, match="non_numeric_value"):
        ps.assert_clean(report(raw(spark, changed(value=text))))


def test_nan_is_an_observation(spark):
    panel = ps.observed_only(ps.canonicalize(raw(spark, changed(value="NaN"))))
    assert math.isnan(rows(panel)[0][5])


@pytest.mark.parametrize("cell", ["entity", "series", "series_code"])
@pytest.mark.parametrize("blank", [None, "", "  "])
def test_blank_identifiers_are_rejected(spark, cell, blank):
    with pytest.raises(ps.InvalidRows, match="missing_identifier"):
        ps.assert_clean(report(raw(spark, changed(**{cell: blank}))))


@pytest.mark.parametrize("blank", [None, "", "  "])
def test_blank_entity_code_passes_the_checks(spark, blank):
    ps.assert_clean(report(raw(spark, changed(code=blank))))


@pytest.mark.parametrize("year", [None, "", "202", "20230", "+2023", "2023.0", "not a year"])
def test_malformed_periods_are_rejected(spark, year):
    with pytest.raises(ps.InvalidRows, match="invalid_period"):
        ps.assert_clean(report(raw(spark, changed(year=year))))


@pytest.mark.parametrize("year, expected", [("0000", 0), (" 1999 ", 1999), ("2023\n", 2023)])
def test_accepted_periods(spark, year, expected):
    source = raw(spark, changed(year=year))
    ps.assert_clean(report(source))
    assert rows(ps.canonicalize(source))[0][4] == expected


def test_period_stored_as_double_is_rejected(spark):
    schema = RAW.replace("`Year` string", "`Year` double")
    source = spark.createDataFrame([changed(year=2023.0)], schema)
    assert report(source)["invalid_period"] == 1


@pytest.mark.parametrize(
    "kind, value, expected",
    [
        ("double", 0.1, 0.1),
        ("float", 0.1, 0.1),
        ("int", 7, 7.0),
        ("bigint", 2**53 + 1, float(2**53 + 1)),
        ("decimal(20,4)", Decimal("0.1000"), 0.1),
    ],
)
def test_native_values_equal_their_text(spark, kind, value, expected):
    schema = RAW.replace("`Value` string", f"`Value` {kind}")
    source = spark.createDataFrame([changed(value=value)], schema)
    ps.assert_clean(report(source))
    assert rows(ps.canonicalize(source))[0][5] == expected


def test_boolean_values_are_rejected(spark):
    schema = RAW.replace("`Value` string", "`Value` boolean")
    assert report(spark.createDataFrame([changed(value=True)], schema))["non_numeric_value"] == 1


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint", "decimal(4,0)"])
def test_native_periods(spark, kind):
    schema = RAW.replace("`Year` string", f"`Year` {kind}")
    value = Decimal(2023) if kind.startswith("decimal") else 2023
    source = spark.createDataFrame([changed(year=value)], schema)
    ps.assert_clean(report(source))
    result = ps.canonicalize(source)
    assert dict(result.dtypes)["Year"] == "int"
    assert rows(result)[0][4] == 2023


def test_rules_are_enforced_in_order(spark):
    all_broken = raw(spark, changed(series=" ", year="x", value="y"))
    with pytest.raises(ps.InvalidRows, match="missing_identifier"):
        ps.assert_clean(report(all_broken))
    two_broken = raw(spark, changed(year="x"), changed(value="y"))
    with pytest.raises(ps.InvalidRows, match="invalid_period"):
        ps.assert_clean(report(two_broken))


def test_report_counts_equal_rejected_rows(spark):
    source = raw(
        spark,
        GOOD,
        changed(series=None, year="x"),
        changed(year="y", value="z"),
        changed(value="z"),
        changed(entity=" "),
    )
    rejected = ps.rejected_rows(source)
    counts = report(source)
    assert counts["total_rows"] == 5
    for rule in ("missing_identifier", "invalid_period", "non_numeric_value"):
        listed = [r for r in records(rejected) if rule in r["reasons"]]
        assert counts[rule] == len(listed) == 2
    assert rejected.count() == 4


def test_report_of_an_empty_panel(spark):
    counts = report(spark.createDataFrame([], RAW))
    assert set(counts.values()) == {0}


def test_missing_columns_are_named_in_order_and_case_counts(spark):
    source = raw(spark, GOOD).drop("Country Code").withColumnRenamed("Value", "value")
    with pytest.raises(ps.MissingColumns, match="Country Code, Value"):
        ps.canonicalize(source)
    with pytest.raises(ps.MissingColumns):
        ps.quality_report(source)


def test_load_panel_checks_and_projects(spark, tmp_path):
    spark.createDataFrame([changed(code=" lnd ", year=2020, value=None)], LONG).write.parquet(
        f"{tmp_path}/good"
    )
    assert rows(ps.load_panel(spark, f"{tmp_path}/good")) == [
        ("Land", "lnd", "Births", "B.1", 2020, None)
    ]
    raw(spark, changed(year="x")).write.parquet(f"{tmp_path}/bad")
    with pytest.raises(ps.InvalidRows):
        ps.load_panel(spark, f"{tmp_path}/bad")
    assert rows(ps.load_panel(spark, f"{tmp_path}/bad", check=False))[0][4] is None


def test_names_with_dots_and_backticks(spark):
    spec = ps.PanelSpec("a.b", "c`d", "e f", "g", "h", "i.j")
    source = spark.createDataFrame([GOOD], RAW).toDF(*spec.columns)
    ps.assert_clean(report(source, spec))
    assert rows(ps.canonicalize(source, spec)) == [("Land", "LND", "Births", "B.1", 2020, 1.5)]


def test_observed_filter_reaches_the_scan_for_native_values(spark, tmp_path):
    spark.createDataFrame([changed(year=2020, value=1.0)], LONG).write.parquet(f"{tmp_path}/p")
    panel = ps.load_panel(spark, f"{tmp_path}/p")
    assert "IsNotNull(Value)" in plan(ps.observed_only(panel)).split("PushedFilters")[-1]


def test_report_is_one_scan(spark, tmp_path):
    raw(spark, GOOD).write.parquet(f"{tmp_path}/p")
    physical = plan(ps.quality_report(spark.read.parquet(f"{tmp_path}/p")))
    physical = physical.split("== Physical Plan ==")[-1]
    assert physical.count("FileScan") == 1
    assert "Python" not in physical


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_text_of_any_physical_type_is_trimmed_and_checked(spark, kind):
    source = raw(
        spark, (" Alpha ", " A ", " S ", " s ", " 2020 ", " 1.5 "), ("L", "B", " ", "s", "x", "y")
    )
    typed = source.select([F.col(f"`{c}`").cast(kind).alias(c) for c in source.columns])
    assert rows(ps.canonicalize(typed))[0] == ("Alpha", "A", "S", "s", 2020, 1.5)
    report = ps.quality_report(typed).first().asDict()
    assert report == {
        "total_rows": 2, "missing_identifier": 1, "invalid_period": 1, "non_numeric_value": 1,
    }
