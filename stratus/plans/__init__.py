"""Composed pipelines."""
