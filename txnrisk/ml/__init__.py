"""Spark ML pipelines and model-selection loops."""
