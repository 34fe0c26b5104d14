"""Keyed tables that grow by batches: latest row per key, in partitions.

    <path>/<partition columns>/        the rows
    <path>_index/home=<batch>/         key → partition, one folder per batch
    <path>_index/_buckets              the index's number of buckets

A batch brings new and changed rows.  Its keys may already live in other partitions, so
the index names those they live in; only these and the batch's own partitions are read and
replaced.  The index is append-only: a key that moved leaves an old entry, which costs
a partition more to read and changes no result.  It is bucketed by key, so a lookup shuffles
the batch's keys only, and Spark prunes index rows by a runtime Bloom filter of these keys
where the index is large; every ``FOLD`` batches its folders are folded into one.  So a
batch costs what it touches, not what came before it.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart.operators import layout
from bankmart.operators.buckets import note_buckets, noted_buckets, read_bucketed, write_bucketed
from bankmart.session import delete_folder, partition_values

FOLD = 32
_INDEX = T.StructType([T.StructField("id", T.StringType()), T.StructField("place", T.StringType()),
                       T.StructField("home", T.StringType())])
UNKNOWN = "__HIVE_DEFAULT_PARTITION__"  # folder of NULL and of the empty text


def _key(key: str) -> Column:
    """The key as text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def _place(by: list[str]) -> Column:
    """A row's partition as text."""
    def part(c):
        text = F.col(c).cast("string")
        return F.when(F.length(text) > 0, text).otherwise(UNKNOWN)
    return F.concat_ws("/", *[part(c) for c in by])


class KeyedTable:
    """A keyed table at ``path``, partitioned by the columns ``by`` (of few values: the
    partitions that a batch touches are listed on the driver)."""

    def __init__(self, spark: SparkSession, path: str, key: str, by: list[str]):
        self.spark, self.path, self.key, self.by = spark, path, key, by
        self.index_path = f"{path}_index"

    def read(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path)

    # ── index ───────────────────────────────────────────────────────────────
    def _entries(self, rows: DataFrame) -> DataFrame:
        return rows.select(_key(self.key).alias("id"), _place(self.by).alias("place")).distinct()

    def _folders(self) -> list[str]:
        return partition_values(self.spark, self.index_path, "home=")

    def _indexed(self) -> DataFrame:
        """All index folders as one bucketed table, partitioned by folder."""
        n = noted_buckets(self.spark, f"{self.index_path}/_buckets")
        return read_bucketed(self.spark, self.index_path, _INDEX, n, "id", "home")

    def _note(self, rows: DataFrame, batch: str, first: bool = False) -> None:
        """Add the homes of a batch's rows, folding the index once it has many folders."""
        spark, note = self.spark, f"{self.index_path}/_buckets"
        if first:
            delete_folder(spark, self.index_path)
            note_buckets(spark, note, int(spark.conf.get("spark.sql.shuffle.partitions")))
        n, folders = noted_buckets(spark, note), [f for f in self._folders() if f != batch]
        entries = self._entries(rows).repartition(n, "id")
        fold = len(folders) >= FOLD
        if fold:
            entries = self._indexed().select("id", "place").unionByName(entries).distinct()
        beside = f"{self.index_path}_new-{batch}"
        write_bucketed(entries.withColumn("home", F.lit(batch)), beside, n, "id", "home")
        delete_folder(spark, f"{self.index_path}/home={batch}")
        _move(spark, f"{beside}/home={batch}", f"{self.index_path}/home={batch}")
        delete_folder(spark, beside)
        for old in folders if fold else []:
            delete_folder(spark, f"{self.index_path}/home={old}")

    def homes(self, rows: DataFrame) -> list[str]:
        """Partitions in which keys of ``rows`` may live."""
        n = noted_buckets(self.spark, f"{self.index_path}/_buckets")
        ids = rows.select(_key(self.key).alias("id")).distinct().repartition(n, "id")
        found = self._indexed().join(ids, "id", "left_semi").select("place").distinct()
        return sorted(r["place"] for r in found.collect())

    def _places(self, rows: DataFrame) -> set[str]:
        return {r["p"] for r in rows.select(_place(self.by).alias("p")).distinct().collect()}

    # ── writes ──────────────────────────────────────────────────────────────
    def rebuild(self, rows: DataFrame, batch: str) -> None:
        """Replace the whole table."""
        layout.write_partitioned_balanced(rows, self.path, self.by)
        self._note(self.read(rows.schema), batch, first=True)

    def merge(self, new: DataFrame, batch: str) -> list[str]:
        """Bring a batch's rows (one per key) in; returns the partitions it touched."""
        own = self._places(new)
        touched = sorted({*self.homes(new), *own})
        if not touched:
            return []
        mine = new.select(_key(self.key).alias("_id"))
        kept = (self.read(new.schema).where(_place(self.by).isin(touched))
                .join(mine, _key(self.key) == F.col("_id"), "left_anti"))
        filled = self._places(kept) | own
        layout.write_partitioned_balanced(kept.unionByName(new), self.path, self.by, dynamic=True)
        for place in set(touched) - filled:
            folder = self._folder(place)
            if folder:
                delete_folder(self.spark, folder)
        self._note(new, batch)
        return touched

    def _folder(self, place: str) -> str | None:
        """Folder of a partition (folder names are percent-encoded)."""
        path = self.path
        values = [place] if len(self.by) == 1 else place.split("/")
        for column, value in zip(self.by, values):
            name = next((v for v in partition_values(self.spark, path, f"{column}=") if unquote(v) == value), None)
            if name is None:
                return None
            path = f"{path}/{column}={name}"
        return path


def _move(spark: SparkSession, src: str, dst: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (src, dst))
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if fs.exists(a) and not fs.rename(a, b):
        raise OSError(f"cannot move {src} to {dst}")
