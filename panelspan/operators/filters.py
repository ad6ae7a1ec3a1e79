"""Row filters on a canonical panel."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.defaults import AGGREGATE_ENTITY_CODES
from panelspan.functions import column, text
from panelspan.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup
from panelspan.spec import PANEL, PanelSpec


def observed_only(panel: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Rows with a value. NaN is a value."""
    return panel.filter(column(spec.value).isNotNull())


def _compared(name: str) -> Column:
    return F.upper(text(name))


def exclude_entities(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    codes: Collection[str] = AGGREGATE_ENTITY_CODES,
) -> DataFrame:
    """Drop rows whose entity code is blank or among ``codes``.

    Codes are compared without outer spaces and without regard to case; the
    stored code stays as it is. The list becomes a set test inside the scan.
    """
    kept = _compared(spec.entity_code) != ""
    if codes:
        kept = kept & ~_compared(spec.entity_code).isin([code.strip().upper() for code in codes])
    return panel.filter(kept)


def exclude_listed_entities(
    panel: DataFrame,
    codes: DataFrame,
    code_column: str,
    spec: PanelSpec = PANEL,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """As ``exclude_entities``, with the codes in a table of any size.

    Measures the table first (one job): it is broadcast within the limit and
    joined by a salted shuffle beyond it.
    """
    key = "_compared_entity_code"
    listed = codes.select(_compared(code_column).alias(key)).filter(F.col(key) != "").distinct()
    kept = panel.withColumn(key, _compared(spec.entity_code)).filter(F.col(key) != "")
    return lookup(
        kept,
        listed,
        key,
        how="left_anti",
        small=fits_broadcast(listed, broadcast_bytes),
        spread_by=[spec.series_code, spec.period],
    ).drop(key)
