"""Build small typed frames for micro-fixture tests."""

from __future__ import annotations

from datetime import datetime

from bankmart import schemas
from bankmart.config import DEFAULT
from bankmart.operators import bronze


def frame(spark, schema, rows: list[dict]):
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def bronze_frame(spark, source: str, rows: list[dict], cfg=DEFAULT):
    base = {"record_created_at": datetime(2001, 11, 4)}
    df = frame(spark, schemas.SOURCES[source], [{**base, **r} for r in rows])
    return bronze.stamp(df, "TEST", f"{source}.csv", cfg)
