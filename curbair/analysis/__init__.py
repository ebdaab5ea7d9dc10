"""Demand against pollution: joins, correlation, lag, trend and hotspots."""
