"""Composite pipelines and distributed model jobs (MLlib + aggregates)."""
