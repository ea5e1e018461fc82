"""Pipelines, projections of the driver's tables, and registered queries."""
