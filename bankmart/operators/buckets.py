"""Bucketed Parquet folders that outlive a session.

Spark keeps bucketing in the catalogue, so a folder written by one session is
registered again, under a name made from its path, by the next one that reads it.
A join on the bucket column then moves only the other side.  The number of buckets is
noted beside the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart.session import delete_folder


def _name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, buckets: int, by: str, partition_by: str) -> None:
    """Replace ``path`` with ``df``, bucketed and sorted by ``by``.  No shuffle: ``df`` should
    come partitioned by ``by`` into ``buckets``, which makes one file per bucket."""
    spark, name = df.sparkSession, _name(path)
    delete_folder(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.write.format("parquet").mode("overwrite").partitionBy(partition_by)
       .bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")                     # external: the files stay


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, by: str,
                  partition_by: str) -> DataFrame:
    """The folder as a bucketed table of the session's catalogue; ``schema`` has all columns."""
    name = _name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({partition_by}) "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def note_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").json(path)


def noted_buckets(spark: SparkSession, path: str) -> int:
    return spark.read.schema("buckets int").json(path).first()["buckets"]
