"""Composed pipelines, models and the query registry."""
