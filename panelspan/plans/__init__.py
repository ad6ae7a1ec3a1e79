"""Operators composed into the panel job."""

from panelspan.plans.job import PanelOutputs, long_panel, publish_panel

__all__ = ["PanelOutputs", "long_panel", "publish_panel"]
