"""Headered CSV landing files: typed scan of a drop folder.

A drop is ``<folder>/<source>/`` with headered CSV files of one header.  Types are
declared, never inferred; columns are found by their names in the header, so a
source may add, drop or reorder columns.  A column that the schema does not know
is text, or has the type that the caller declares for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


#: a compressed file is read by one task, so its rows are bounded
ROWS_PER_FILE = 1_000_000


def write_landing_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Write an extract as headered CSV, preserving surrounding spaces
    (the Silver layer is the one that trims); ``compressed`` for large drops."""
    w = df.write.mode("overwrite").option("header", True)
    if compressed:
        w = w.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
    (w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
      .csv(path))


def _reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             keep_corrupt: bool = True) -> DataFrame:
    """Typed CSV scan.  Malformed rows are kept (``PERMISSIVE``) with their
    raw text in ``_corrupt_record`` so the load never silently loses rows."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)]) \
        if keep_corrupt else schema
    reader = _reader(spark, full)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def header_schema(spark: SparkSession, path: str, schema: T.StructType,
                  declared: dict[str, str] | None = None) -> T.StructType:
    """Schema of a drop in the order of its header (one line is read)."""
    names = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True) \
        .option("ignoreTrailingWhiteSpace", True).csv(path).columns
    known = {f.name: f.dataType for f in schema.fields}
    extra = {n: T.StructType.fromDDL(f"c {t}")["c"].dataType for n, t in (declared or {}).items()}
    return T.StructType([T.StructField(n, known.get(n, extra.get(n, T.StringType()))) for n in names])


def read_drop(spark: SparkSession, path: str, schema: T.StructType,
              declared: dict[str, str] | None = None) -> DataFrame:
    """One source's drop: the schema's columns (NULL where the header lacks one), the
    header's other columns, ``_corrupt_record`` and ``_input`` (file and offset of the block
    that a row was read from).

    Every file's header must be the same: another one fails the read instead of shifting
    values into wrong columns."""
    found = header_schema(spark, path, schema, declared)
    full = T.StructType(list(found.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    rows = (_reader(spark, full).option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", False).csv(path)
            .withColumn("_input", F.concat_ws(":", "_metadata.file_path",
                                              F.col("_metadata.file_block_start").cast("string"))))
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in found.names}
    new = [n for n in found.names if n not in schema.names]
    return rows.withColumns(missing).select(*schema.names, *new, CORRUPT, "_input")
