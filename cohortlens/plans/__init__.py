"""Queries over the given tables, and the workloads that chain operators."""
