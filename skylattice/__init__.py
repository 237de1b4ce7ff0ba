"""Satellite image time series as Spark tables."""
