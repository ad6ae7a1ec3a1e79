"""Readers of raw panels and of series dimensions."""

from panelspan.sources.dimension import load_dimension
from panelspan.sources.panel import load_panel

__all__ = ["load_dimension", "load_panel"]
