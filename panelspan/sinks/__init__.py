"""Staged publishing and compacted exports."""

from panelspan.sinks.export import export_dataset, stage_export
from panelspan.sinks.journal import recover
from panelspan.sinks.names import load_series_names
from panelspan.sinks.publication import Publication, publish

__all__ = ["Publication", "export_dataset", "load_series_names", "publish", "recover", "stage_export"]
