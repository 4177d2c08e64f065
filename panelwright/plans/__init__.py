"""End-to-end datasets, panels, reports and forecasts."""
