"""Panel time series analytics on Spark DataFrames."""

from tidepanel.panel import PanelSpec, daily_panel, normalise

__all__ = ["PanelSpec", "daily_panel", "normalise"]
