"""Folders for queries that write and read back."""

from panelspan.sinks.scratch import scratch_folder, staged

__all__ = ["scratch_folder", "staged"]
