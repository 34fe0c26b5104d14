"""Operators for training-data pipelines (see ``queries.py`` for the registry)."""
