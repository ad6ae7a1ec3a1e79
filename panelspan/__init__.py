"""Long-panel toolkit for Spark: check, clean, enrich, reshape and publish."""

from panelspan.errors import (
    ConflictingTopics,
    DuplicateCells,
    InvalidHeaders,
    InvalidRows,
    MissingColumns,
    PanelError,
)
from panelspan.operators.dimension import (
    assert_no_conflicts,
    clean_dimension,
    dimension_conflicts,
    enrich,
    topic_by_code,
    unmapped_series,
    used_dimension,
)
from panelspan.operators.filters import (
    exclude_entities,
    exclude_listed_entities,
    observed_only,
)
from panelspan.operators.normalize import canonicalize
from panelspan.operators.quality import (
    assert_clean,
    assert_unique,
    duplicate_keys,
    duplicate_period_cells,
    duplicate_series_cells,
    quality_report,
    rejected_rows,
)
from panelspan.operators.reshape import (
    pivot_headers,
    pivot_period,
    pivot_series,
    pivot_series_by_topic,
    series_blocks,
    series_cells,
    series_headers,
    topic_headers,
)
from panelspan.plans.job import PanelOutputs, long_panel, publish_panel
from panelspan.sinks import (
    Publication,
    export_dataset,
    load_series_names,
    publish,
    recover,
    stage_export,
)
from panelspan.sources import load_dimension, load_panel
from panelspan.spec import DIMENSION, PANEL, DimensionSpec, PanelSpec, check_columns

__all__ = [
    "DIMENSION",
    "PANEL",
    "ConflictingTopics",
    "DimensionSpec",
    "DuplicateCells",
    "InvalidHeaders",
    "InvalidRows",
    "MissingColumns",
    "PanelError",
    "PanelOutputs",
    "PanelSpec",
    "Publication",
    "assert_clean",
    "assert_no_conflicts",
    "assert_unique",
    "canonicalize",
    "check_columns",
    "clean_dimension",
    "dimension_conflicts",
    "duplicate_keys",
    "duplicate_period_cells",
    "duplicate_series_cells",
    "enrich",
    "exclude_entities",
    "exclude_listed_entities",
    "export_dataset",
    "load_dimension",
    "load_panel",
    "load_series_names",
    "long_panel",
    "observed_only",
    "pivot_headers",
    "pivot_period",
    "pivot_series",
    "pivot_series_by_topic",
    "publish",
    "publish_panel",
    "quality_report",
    "recover",
    "rejected_rows",
    "series_blocks",
    "series_cells",
    "series_headers",
    "stage_export",
    "topic_by_code",
    "topic_headers",
    "unmapped_series",
    "used_dimension",
]
