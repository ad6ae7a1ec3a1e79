"""The canonical projection of a raw panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspan.functions import as_number, as_period, trimmed
from panelspan.spec import PANEL, PanelSpec, check_columns


def canonicalize(raw: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Bring a raw panel to the six canonical columns, in order.

    Names and codes become trimmed text, the period int and the value double;
    other columns are dropped. A period or value that cannot be read becomes
    null here: the quality checks report such rows before anything is published.
    """
    check_columns(raw, spec.columns)
    names = [spec.entity_name, spec.entity_code, spec.series_name, spec.series_code]
    return raw.select(
        *[trimmed(name).alias(name) for name in names],
        as_period(raw, spec.period).alias(spec.period),
        as_number(raw, spec.value).alias(spec.value),
    )
