"""Joins to lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str,
                how: str = "left") -> DataFrame:
    """Join without a hint: the byte threshold and AQE choose the strategy."""
    return facts.join(lookup, facts[fact_key] == lookup[lookup_key], how)
