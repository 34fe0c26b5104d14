"""Additive schema changes of an append-only table on disk.

Every batch folder has a Parquet schema of its own.  ``merged`` is their least upper
bound: columns in order of first appearance, types by a widening lattice
(byte → short → int → long → double, float → double, date → timestamp_ntz; arrays and
structs by their parts; NULL below everything).  Types without an upper bound are a
conflict and are reported, never guessed.  ``read`` returns all batches in the merged
schema: folders of one schema are read together, and a folder's own types are cast
upward, so no file is rewritten.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart.session import committed_subdirs, partition_values

_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]


class SchemaConflict(ValueError):
    """Batches hold types of one column that no type covers."""


@dataclass(frozen=True)
class Conflict:
    column: str
    batch: str
    known: str
    found: str

    def __str__(self):
        return f"{self.column}: {self.known} up to batch {self.batch}, which has {self.found}"


def widen(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """Least type that holds both, or None."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
        if isinstance(x, T.FloatType) and y in _NUMBERS:
            return T.DoubleType()
    if a in _NUMBERS and b in _NUMBERS:
        return _NUMBERS[max(_NUMBERS.index(a), _NUMBERS.index(b))]
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = widen(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields, conflicts = _merge(list(a.fields), list(b.fields), "")
        return None if conflicts else T.StructType(fields)
    return None


def _merge(known: list, new: list, batch: str):
    out, conflicts = {f.name: f for f in known}, []
    for f in new:
        if f.name not in out:
            out[f.name] = T.StructField(f.name, f.dataType, True)
            continue
        was = out[f.name].dataType
        wide = widen(was, f.dataType)
        if wide is None:
            conflicts.append(Conflict(f.name, batch, was.simpleString(), f.dataType.simpleString()))
        else:
            out[f.name] = T.StructField(f.name, wide, True)
    return list(out.values()), conflicts


def merged(schemas: list[tuple[str, T.StructType]]) -> tuple[T.StructType, list[Conflict]]:
    """Least upper bound of the batches' schemas and the columns that have none (these
    keep their earlier type)."""
    fields, conflicts = [], []
    for batch, schema in schemas:
        fields, more = _merge(fields, schema.fields, batch)
        conflicts += more
    return T.StructType(fields), conflicts


def _ledger(path: str) -> str:
    return f"{path}/_schemas"


def record(spark: SparkSession, path: str, batch: str, schema: T.StructType) -> None:
    """Note a landed batch's schema beside the table, so that later runs read one small
    ledger and no footers."""
    row = spark.range(1).select(F.lit(batch).alias("batch"), F.lit(schema.json()).alias("schema"))
    row.write.mode("overwrite").json(f"{_ledger(path)}/of={batch}")


def batch_schemas(spark: SparkSession, path: str, prefix: str = "_batch_id=") -> list[tuple[str, T.StructType]]:
    """Parquet schema of every committed batch folder, oldest first: from the ledger, else
    from a footer (a batch is one write, so its files agree).  Partition columns are text.
    What reaches the driver is one line per batch."""
    noted = {}
    if partition_values(spark, _ledger(path), "of="):
        for r in spark.read.schema("batch string, schema string").json(_ledger(path)).collect():
            noted[r["batch"]] = T.StructType.fromJson(json.loads(r["schema"]))
    out = []
    for batch in committed_subdirs(spark, path, prefix):
        if batch in noted:
            out.append((batch, noted[batch]))
            continue
        folder = f"{path}/{prefix}{batch}"
        fields = spark.read.option("basePath", folder).parquet(folder).schema.fields
        inner = _partition_columns(spark, folder)
        out.append((batch, T.StructType([T.StructField(f.name, T.StringType() if f.name in inner else f.dataType, True)
                                         for f in fields])))
    return out


def _partition_columns(spark: SparkSession, folder: str) -> set[str]:
    """Names of the folder's partition columns (its first branch of folders)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    names, at = set(), jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(conf)
    while True:
        inside = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inside:
            return names
        names.add(inside[0].getName().split("=")[0])
        at = inside[0]


def check(schemas: list[tuple[str, T.StructType]]) -> T.StructType:
    """Merged schema, or SchemaConflict with every conflict."""
    schema, conflicts = merged(schemas)
    if conflicts:
        raise SchemaConflict("; ".join(map(str, conflicts)))
    return schema


def read(spark: SparkSession, path: str, prefix: str = "_batch_id=", batches: list[str] | None = None) -> DataFrame:
    """All committed batches (or ``batches``) in the merged schema of all of them, with the
    batch folder's name as a text column.  Folders of one schema share a scan."""
    found = batch_schemas(spark, path, prefix)
    if not found:
        raise ValueError(f"no committed batch in {path}")
    schema, column = check(found), prefix.rstrip("=")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for batch, own in found:
        if batches is None or batch in batches:
            groups.setdefault(own.json(), (own, []))[1].append(batch)
    parts = []
    for own, names in groups.values():
        scan = (spark.read.schema(T.StructType(own.fields + [T.StructField(column, T.StringType())]))
                .option("basePath", path).parquet(*[f"{path}/{prefix}{b}" for b in names]))
        parts.append(scan.select(*[(F.col(f.name) if f.name in own.names else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in schema.fields], column))
    if not parts:
        return spark.createDataFrame([], T.StructType(schema.fields + [T.StructField(column, T.StringType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
