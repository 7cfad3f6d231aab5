"""Sensor-signal analytics on Spark: streaming ingestion, hourly aggregates, bands, models."""
