"""Cohort analytics on Spark: event cohorts, features, graphs, series, models."""

__version__ = "0.1.0"
