"""Keep the latest row per key (top-1 per group)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(spec) -> Column:
    if isinstance(spec, Column):
        return spec
    name, direction = spec if isinstance(spec, tuple) else (spec, "asc")
    c = F.col(name)
    return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last()


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """``row_number() = 1`` over ``keys`` ordered by ``order``.

    ``order`` must be a total order within a key (add business columns after
    the ingest time) so the survivor is the same on every run.  Catalyst
    plans this as a partial ``WindowGroupLimit`` before the shuffle and a
    final one after it, so a hot key is already cut to one row per map
    task before it is exchanged.  No explicit repartition: the window's own
    hash exchange is the only shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*[_order(o) for o in order])
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


INGEST_ORDER = [("_ingest_ts", "desc"), ("_batch_id", "desc")]
