"""Names of the columns of a panel and of its series dimension."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from panelspan import defaults
from panelspan.errors import MissingColumns


@dataclass(frozen=True)
class PanelSpec:
    """Column names of a long panel: one row per entity, series and period."""

    entity_name: str = defaults.ENTITY_NAME
    entity_code: str = defaults.ENTITY_CODE
    series_name: str = defaults.SERIES_NAME
    series_code: str = defaults.SERIES_CODE
    period: str = defaults.PERIOD
    value: str = defaults.VALUE
    topic: str = defaults.TOPIC
    period_pattern: str = defaults.PERIOD_PATTERN

    @property
    def columns(self) -> list[str]:
        """The canonical columns, in order."""
        return [
            self.entity_name,
            self.entity_code,
            self.series_name,
            self.series_code,
            self.period,
            self.value,
        ]

    @property
    def identifiers(self) -> list[str]:
        """Columns that must not be blank. The entity code may be; a filter drops it."""
        return [self.entity_name, self.series_name, self.series_code]

    def series_shape_keys(self, panel: DataFrame) -> list[str]:
        """Row key of the shape with one column per series."""
        return self._with_topic([self.entity_name, self.entity_code, self.period], panel)

    def period_shape_keys(self, panel: DataFrame) -> list[str]:
        """Row key of the shape with one column per period."""
        return self._with_topic(
            [self.entity_name, self.entity_code, self.series_name, self.series_code], panel
        )

    def _with_topic(self, keys: list[str], panel: DataFrame) -> list[str]:
        return [*keys, self.topic] if self.topic in panel.columns else keys


@dataclass(frozen=True)
class DimensionSpec:
    """Column names of the series dimension."""

    key: str = defaults.DIMENSION_KEY
    topic: str = defaults.DIMENSION_TOPIC
    published: tuple[str, ...] = defaults.DIMENSION_COLUMNS


PANEL = PanelSpec()
DIMENSION = DimensionSpec()


def check_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise if ``df`` lacks a column; names must match in case. Starts no job."""
    present = set(df.columns)
    missing = [name for name in required if name not in present]
    if missing:
        raise MissingColumns(f"Missing columns: {', '.join(missing)}")
