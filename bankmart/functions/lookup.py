"""Small constant lookups expressed as CASE / array literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based integer index column."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (index + F.lit(1)).cast("int"))


def case_map(col: Column, mapping, default=None) -> Column:
    """CASE col WHEN k THEN v … ELSE default END."""
    expr = None
    for k, v in (mapping.items() if isinstance(mapping, dict) else mapping):
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default))
