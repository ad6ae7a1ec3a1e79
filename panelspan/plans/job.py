"""The panel job: check, clean, enrich, reshape and publish four outputs together.

The raw panel is read once. The quality counts are observed on that scan while
the long output is being staged; there is no shuffle up to here when the
dimension fits a broadcast. The staged long output is a written table, and every
other output starts from it: executors may be lost without repeating the scan,
and no cache has to hold the panel. All outputs are swapped in at the end.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession

from panelspan.defaults import AGGREGATE_ENTITY_CODES
from panelspan.errors import ConflictingTopics, DuplicateCells
from panelspan.functions import column
from panelspan.operators.dimension import (
    assert_no_conflicts,
    attach_topics,
    enrich,
    topic_by_code,
    used_dimension,
)
from panelspan.operators.filters import exclude_entities, observed_only
from panelspan.operators.lookup import BROADCAST_BYTES, shuffle_partitions
from panelspan.operators.normalize import canonicalize
from panelspan.operators.quality import assert_clean, quality_counts, quality_report
from panelspan.operators.reshape import (
    DUPLICATE_CELL,
    MOST_COLUMNS,
    check_headers,
    pivot_period,
    pivot_series,
    pivot_series_by_topic,
    series_headers,
    shape_headers,
    shape_partitions,
    topic_headers,
)
from panelspan.sinks.files import Files
from panelspan.sinks.names import NAMES_FOLDER
from panelspan.sinks.publication import Publication
from panelspan.spec import DIMENSION, PANEL, DimensionSpec, PanelSpec, check_columns

# Repeated names take little room in Parquet and their full length in a shuffle: about
# 12 bytes per row became about 100. This is some 5 million rows and half a gigabyte.
PARQUET_BYTES_PER_PARTITION = 64 * 1024 * 1024
# More partitions cost the driver more than they spare the tasks: map outputs are tracked
# for each pair of tasks. Beyond this, partitions grow and spill; no row depends on it.
MOST_PARTITIONS = 20_000


@dataclass(frozen=True)
class PanelOutputs:
    """Where the four outputs go."""

    long: str
    series_wide: str
    period_wide: str
    dimension: str


def long_panel(
    raw: DataFrame,
    dimension: DataFrame,
    spec: PanelSpec = PANEL,
    names: DimensionSpec = DIMENSION,
    excluded: Collection[str] = AGGREGATE_ENTITY_CODES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The enriched long panel of a raw panel, without the quality check. Lazy but for the
    check and measurement of the dimension."""
    return enrich(_selected(raw, spec, excluded), dimension, spec, names, broadcast_bytes)


def _selected(raw: DataFrame, spec: PanelSpec, excluded: Collection[str]) -> DataFrame:
    return exclude_entities(observed_only(canonicalize(raw, spec), spec), spec, excluded)


def publish_panel(
    spark: SparkSession,
    raw: DataFrame,
    dimension: DataFrame,
    outputs: PanelOutputs,
    spec: PanelSpec = PANEL,
    names: DimensionSpec = DIMENSION,
    excluded: Collection[str] = AGGREGATE_ENTITY_CODES,
    broadcast_bytes: int = BROADCAST_BYTES,
    single_dimension_file: bool = False,
    max_headers: int | None = None,
    series_wide_by_topic: bool = False,
    most_columns: int = MOST_COLUMNS,
) -> None:
    """Run the whole job. On any broken rule nothing is published.

    The dimension is a folder of CSV files sorted over all of them, or one file, as
    ``single_dimension_file`` says, at any size. ``max_headers`` bounds the columns of
    each wide shape; without it there is no bound. With ``series_wide_by_topic`` the series
    shape is a dataset partitioned by topic, each part with its own series alone.

    Beyond ``most_columns`` series (in one topic, where it is by topic) the series shape
    is published in blocks of columns, as ``pivot_series`` makes them; the table of its
    names lies in the dataset, and ``load_series_names`` reads it.

    Raises ``InvalidRows``, ``ConflictingTopics``, ``DuplicateCells`` or
    ``InvalidHeaders``.
    """
    check_columns(raw, spec.columns)
    check_columns(dimension, names.published)
    with Publication(spark) as publication:
        published = [column(name) for name in names.published]
        dimension = publication.table(dimension.select(*published), near=outputs.dimension)
        topics = topic_by_code(dimension, spec, names)
        try:
            size = assert_no_conflicts(topics, spec)
        except ConflictingTopics:
            # Broken rows are reported before a broken dimension.
            assert_clean(quality_report(raw, spec).first().asDict())
            raise

        seen = Observation()
        selected = _selected(observed(raw, seen, spec), spec, excluded)
        enriched = attach_topics(selected, topics, spec, small=size.bytes <= broadcast_bytes)
        staged = publication.stage_parquet(enriched, outputs.long)
        assert_clean(_counts(seen, raw, spec))

        panel = spark.read.schema(enriched.schema).parquet(staged)

        @inheritable_thread_target(spark)
        def stage_dimension() -> None:
            used = used_dimension(dimension, panel, spec, names, broadcast_bytes)
            publication.stage_csv(
                used,
                outputs.dimension,
                single_file=single_dimension_file,
                order_by=names.published,
            )

        def table(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
            return publication.table(df, outputs.series_wide, partition_by)

        # Colliding names fail here, before anything wide is written.
        periods = shape_headers(panel, [spec.period], max_headers)[spec.period]
        check_headers(panel, spec.period_shape_keys(panel), periods)
        headers_of = topic_headers if series_wide_by_topic else series_headers
        series = headers_of(panel, spec, max_headers, most_columns, table)
        blocks = isinstance(series, DataFrame)
        if not blocks and not series_wide_by_topic:
            check_headers(panel, spec.series_shape_keys(panel), series)
        parts = row_key_partitions(spark, Files(spark).total_bytes(staged)) or 0
        n = panel.count()
        # The small output is made in the gaps that the large ones leave.
        with ThreadPoolExecutor(max_workers=1) as beside:
            dimension_staged = beside.submit(stage_dimension)
            if blocks:
                wide = pivot_series(panel, spec, headers=series, partitions=parts)
                by = [spec.topic] if series_wide_by_topic else []
                shape = _stage_wide(publication, wide, outputs.series_wide, by)
                publication.stage_inside(series, f"{shape}/{NAMES_FOLDER}")
            elif series_wide_by_topic:
                with duplicates_named(outputs.series_wide):
                    by_topic = pivot_series_by_topic(
                        panel, spec, max_headers, parts or None, table
                    )
                    # An empty panel has no topics.
                    wide = list(by_topic.values()) or [pivot_series(panel, spec)]
                    publication.stage_parts(wide, outputs.series_wide, spec.topic)
            else:
                keys = spec.series_shape_keys(panel)
                dealt = max(parts, shape_partitions(panel, keys, len(series), n) or 0)
                # An empty panel has no headers to list.
                wide = pivot_series(panel, spec, headers=series or None, partitions=dealt or None)
                _stage_wide(publication, wide, outputs.series_wide)
            keys = spec.period_shape_keys(panel)
            dealt = max(parts, shape_partitions(panel, keys, len(periods), n) or 0)
            wide = pivot_period(panel, spec, headers=periods or None, partitions=dealt or None)
            _stage_wide(publication, wide, outputs.period_wide)
            dimension_staged.result()


def row_key_partitions(
    spark: SparkSession,
    table_bytes: int,
    bytes_per_partition: int = PARQUET_BYTES_PER_PARTITION,
) -> int | None:
    """How many partitions a Parquet table needs when dealt by row key; None if the session's
    setting, which adaptive execution may lower, is enough."""
    needed = min(MOST_PARTITIONS, math.ceil(table_bytes / bytes_per_partition))
    return needed if needed > shuffle_partitions(spark) else None


def observed(raw: DataFrame, seen: Observation, spec: PanelSpec) -> DataFrame:
    """The needed columns of a raw panel, with the quality counts taken as they pass.

    Spark prunes no columns below an observation, so they are selected first.
    """
    needed = raw.select(*[column(name) for name in spec.columns])
    return needed.observe(seen, *quality_counts(needed, spec))


def _counts(seen: Observation, raw: DataFrame, spec: PanelSpec) -> dict[str, int]:
    """The observed quality counts.

    Spark drops them with the scan when it finds at run time that the join has an
    empty side; the report is then computed on its own.
    """
    try:
        counts = seen.get
    except (PySparkException, Py4JJavaError):
        counts = {}
    return counts or quality_report(raw, spec).first().asDict()


def _stage_wide(
    publication: Publication, wide: DataFrame, target: str, partition_by: Sequence[str] = ()
) -> str:
    with duplicates_named(target):
        return publication.stage_parquet(wide, target, partition_by=partition_by)


@contextmanager
def duplicates_named(target: str) -> Iterator[None]:
    """Turn the error of a repeated cell into ``DuplicateCells``."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if DUPLICATE_CELL in str(error):
            raise DuplicateCells(f"{target}: several observations fall into one cell") from error
        raise
