"""Pipelines and table bindings."""
