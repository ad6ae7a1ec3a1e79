"""Parquet source of a long panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspan.operators.normalize import canonicalize
from panelspan.operators.quality import assert_clean, quality_report
from panelspan.spec import PANEL, PanelSpec


def load_panel(
    spark: SparkSession, path: str, spec: PanelSpec = PANEL, check: bool = True
) -> DataFrame:
    """Scan a raw panel, raise if it breaks a quality rule, return the canonical panel.

    The check is one aggregate over the needed columns; ``check=False`` leaves it
    to the caller, as the publishing job does, which checks while it writes.
    """
    raw = spark.read.parquet(str(path))
    if check:
        assert_clean(quality_report(raw, spec).first().asDict())
    return canonicalize(raw, spec)
