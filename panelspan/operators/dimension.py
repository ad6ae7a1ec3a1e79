"""The series dimension: cleaning, conflicts, attaching topics, used and missing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspan.errors import ConflictingTopics
from panelspan.functions import column, text
from panelspan.operators.lookup import (
    BROADCAST_BYTES,
    TableSize,
    fits_broadcast,
    listed_bits,
    lookup,
    maybe_listed,
    measure,
    size_columns,
)
from panelspan.spec import DIMENSION, PANEL, DimensionSpec, PanelSpec, check_columns

CONFLICT = "_conflict"


def _mappings(dimension: DataFrame, spec: PanelSpec, names: DimensionSpec) -> DataFrame:
    """Trimmed (series code, topic) pairs without blank ones; repeated pairs stay."""
    check_columns(dimension, [names.key, names.topic])
    return dimension.select(
        text(names.key).alias(spec.series_code), text(names.topic).alias(spec.topic)
    ).filter((column(spec.series_code) != "") & (column(spec.topic) != ""))


def clean_dimension(
    dimension: DataFrame, spec: PanelSpec = PANEL, names: DimensionSpec = DIMENSION
) -> DataFrame:
    """The distinct (series code, topic) pairs, trimmed, without blank ones."""
    return _mappings(dimension, spec, names).distinct()


def dimension_conflicts(
    dimension: DataFrame, spec: PanelSpec = PANEL, names: DimensionSpec = DIMENSION
) -> DataFrame:
    """Series codes with more than one topic, and how many they have."""
    return (
        clean_dimension(dimension, spec, names)
        .groupBy(column(spec.series_code))
        .agg(F.count(F.lit(1)).alias("topic_count"))
        .filter(F.col("topic_count") > 1)
    )


def topic_by_code(
    dimension: DataFrame, spec: PanelSpec = PANEL, names: DimensionSpec = DIMENSION
) -> DataFrame:
    """One row per series code: its least topic, and whether it has another one.

    One grouping serves the check for conflicts and the join.
    """
    topic = column(spec.topic)
    return (
        _mappings(dimension, spec, names)
        .groupBy(column(spec.series_code))
        .agg(F.min(topic).alias(spec.topic), (F.min(topic) != F.max(topic)).alias(CONFLICT))
    )


def assert_no_conflicts(topics: DataFrame, spec: PanelSpec = PANEL) -> TableSize:
    """Raise if a code of ``topic_by_code`` has two topics; return the size. One job."""
    row = topics.agg(
        *size_columns([spec.series_code, spec.topic]),
        F.count_if(column(CONFLICT)).alias("conflicts"),
    ).first()
    if row["conflicts"]:
        raise ConflictingTopics(
            f"{row['conflicts']} series codes have several topics; see dimension_conflicts()."
        )
    return TableSize(row["rows"], row["bytes"])


def attach_topics(
    panel: DataFrame, topics: DataFrame, spec: PanelSpec, small: bool
) -> DataFrame:
    """Inner join of a panel with the topics of codes, checked for conflicts."""
    facts = panel.withColumn(spec.series_code, F.trim(column(spec.series_code)))
    joined = lookup(
        facts,
        topics.drop(CONFLICT),
        spec.series_code,
        how="inner",
        small=small,
        spread_by=[spec.entity_code, spec.period],
    )
    return joined.select(*[column(name) for name in [*spec.columns, spec.topic]])


def enrich(
    panel: DataFrame,
    dimension: DataFrame,
    spec: PanelSpec = PANEL,
    names: DimensionSpec = DIMENSION,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Give each row its series' topic; rows of unmapped series are dropped.

    Runs one job over the dimension, which raises on conflicting topics and
    measures the side to be broadcast.
    """
    topics = topic_by_code(dimension, spec, names)
    size = assert_no_conflicts(topics, spec)
    return attach_topics(panel, topics, spec, small=size.bytes <= broadcast_bytes)


def unmapped_series(
    panel: DataFrame,
    dimension: DataFrame,
    spec: PanelSpec = PANEL,
    names: DimensionSpec = DIMENSION,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The series that ``enrich`` would drop, and their rows.

    Rows are counted per series first; only one row per series meets the dimension.
    """
    code = spec.series_code
    counts = (
        panel.select(F.trim(column(code)).alias(code))
        .groupBy(column(code))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    mapped = clean_dimension(dimension, spec, names).select(column(code)).distinct()
    small = fits_broadcast(mapped, broadcast_bytes)
    return lookup(counts, mapped, code, how="left_anti", small=small, spread_by=[code], salts=1)


def used_dimension(
    dimension: DataFrame,
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    names: DimensionSpec = DIMENSION,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Dimension rows whose trimmed key occurs in the panel; repeated rows stay repeated.

    The panel's codes are made distinct first, by partial aggregation, so no panel row
    is moved. Then they are cut down to those that the dimension has: only the
    dimension is measured, and the list of used codes is never larger than its own. Beyond
    ``broadcast_bytes`` a bitmap of the hashed codes tells which dimension rows may be
    used, so that only those move to the join that decides. The sink sorts the rows by key
    when they are published.
    """
    check_columns(dimension, names.published)
    keyed = dimension.select(
        *[
            (F.trim(column(name)) if name == names.key else column(name)).alias(name)
            for name in names.published
        ]
    )
    known = keyed.select(column(names.key)).filter(column(names.key).isNotNull()).distinct()
    size = measure(known)
    small = size.bytes <= broadcast_bytes
    codes = panel.select(column(spec.series_code).alias(names.key)).distinct()
    if not small:
        keyed = maybe_listed(keyed, names.key, listed_bits(codes, names.key, size.rows))
        known = keyed.select(column(names.key)).distinct()
    used = lookup(codes, known, names.key, "left_semi", small, spread_by=[names.key], salts=1)
    others = [name for name in names.published if name != names.key]
    kept = lookup(keyed, used, names.key, "left_semi", small, spread_by=others)
    return kept.select(*[column(name) for name in names.published])
