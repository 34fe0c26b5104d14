"""Registry of named queries: ``key → fn(spark, sf_dir) -> DataFrame``.

Query functions take a :class:`~bankmart.plans.lake.Lake`; the registry
wraps them so callers only pass a session and the data folder.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from bankmart.config import RunConfig, DEFAULT

QUERIES: dict[str, Callable[..., DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def _load_all():
    # importing registers the queries
    from bankmart.plans import (marts, checks, history, analytics, views,  # noqa: F401
                                dashboard, jobs)


def display_form(df: DataFrame) -> DataFrame:
    """Array columns as comma-joined text (how the dashboards show them),
    so results compare as plain scalar values across engines."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not arrays:
        return df
    return df.withColumns({c: F.array_join(F.col(c), ",") for c in arrays})


def queries(cfg: RunConfig = DEFAULT) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Driver-facing callables; outputs in display form (see above)."""
    from bankmart.plans.lake import Lake
    _load_all()

    def bind(fn):
        return lambda spark, sf_dir: display_form(fn(Lake(spark, sf_dir, cfg)))

    return {k: bind(fn) for k, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from bankmart.oracle.queries import ORACLE
    _load_all()
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
