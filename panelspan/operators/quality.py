"""Checks on raw panels and keys: tables first, assertions on top of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.errors import DuplicateCells, InvalidRows
from panelspan.functions import as_number, as_period, column, is_blank, text
from panelspan.functions.columns import has_exact_number
from panelspan.spec import PANEL, PanelSpec, check_columns

#: Repeated hashes of keys that are listed on the driver, 8 bytes each.
MOST_SUSPECTS = 100_000
CODE = "_code"

# The rules in the order in which they are enforced.
RULES = {
    "missing_identifier": "rows without entity name, series name or series code",
    "invalid_period": "rows with a missing or malformed period",
    "non_numeric_value": "rows with a value that is not a number",
}


def violations(raw: DataFrame, spec: PanelSpec = PANEL) -> dict[str, Column]:
    """One condition per rule, true for the rows that break it."""
    no_identifier = reduce(or_, [is_blank(name) for name in spec.identifiers])
    bad_period = (
        ~text(spec.period).rlike(spec.period_pattern) | as_period(raw, spec.period).isNull()
    )
    if has_exact_number(raw, spec.value):
        bad_value = F.lit(False)
    else:
        bad_value = ~is_blank(spec.value) & as_number(raw, spec.value).isNull()
    return dict(zip(RULES, (no_identifier, bad_period, bad_value)))


def quality_counts(raw: DataFrame, spec: PanelSpec = PANEL) -> list[Column]:
    """The aggregates of the quality report, for ``agg`` or ``observe``."""
    counts = [F.count_if(broken).alias(rule) for rule, broken in violations(raw, spec).items()]
    return [F.count(F.lit(1)).alias("total_rows"), *counts]


def quality_report(raw: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """One row: all rows, and the rows that break each rule. A single scan, no shuffle of rows."""
    check_columns(raw, spec.columns)
    return raw.agg(*quality_counts(raw, spec))


def rejected_rows(raw: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """The raw rows that break a rule, with the broken rules in ``reasons``."""
    check_columns(raw, spec.columns)
    broken = violations(raw, spec)
    reasons = [F.when(test, F.lit(rule)) for rule, test in broken.items()]
    return raw.filter(reduce(or_, broken.values())).withColumn(
        "reasons", F.array_compact(F.array(*reasons))
    )


def assert_clean(counts: Mapping[str, int]) -> None:
    """Raise for the first broken rule in a quality report's row (``.first().asDict()``)."""
    for rule, meaning in RULES.items():
        if counts[rule]:
            raise InvalidRows(f"Raw panel holds {meaning} ({rule}); see rejected_rows().")


def duplicate_keys(
    df: DataFrame, keys: Sequence[str], most_suspects: int = MOST_SUSPECTS
) -> DataFrame:
    """Keys that occur more than once, and how often. Null keys are equal to each other.

    Runs a job: it counts 64-bit hashes of the keys, partially aggregated before they move,
    so a key that holds a large share of the rows costs one row per task. Only rows whose
    hash occurs twice are then counted by their whole keys. A clean table so moves one
    number per row in place of its keys, and is not read again. Above ``most_suspects``
    repeated hashes, which go to the driver, all rows are counted by their keys instead.
    """
    columns = [column(key) for key in keys]
    code = F.xxhash64(*columns)
    repeated = (
        df.select(code.alias(CODE))
        .groupBy(CODE)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )
    suspects = [row[CODE] for row in repeated.select(CODE).limit(most_suspects + 1).collect()]
    if not suspects:
        rows = df.filter(F.lit(False))
    elif len(suspects) > most_suspects:
        rows = df
    else:
        listed = df.sparkSession.createDataFrame([(c,) for c in suspects], f"{CODE} long")
        rows = df.join(F.broadcast(listed), code == listed[CODE], "left_semi")
    return (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def duplicate_series_cells(panel: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Cells that one column per series could not hold."""
    return duplicate_keys(panel, [*spec.series_shape_keys(panel), spec.series_name])


def duplicate_period_cells(panel: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Cells that one column per period could not hold."""
    return duplicate_keys(panel, [*spec.period_shape_keys(panel), spec.period])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if some key occurs more than once."""
    if not duplicate_keys(df, keys).isEmpty():
        raise DuplicateCells(f"Several rows share one key: {', '.join(keys)}")
