"""Data-layout jobs: partitioned writes, clustering, compaction, file stats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_FILE_BYTES = 128 * 1024 * 1024


def write_partitioned(df: DataFrame, path: str, by: list[str], dynamic: bool = False) -> None:
    """Overwrite a partitioned table; ``dynamic`` replaces only the
    partitions present in ``df`` (incremental reruns)."""
    w = df.write.mode("overwrite").partitionBy(*by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_partitioned_balanced(df: DataFrame, path: str, by: list[str],
                               dynamic: bool = False) -> None:
    """Partitioned write without the small-files blow-up or a hot-value task.

    After a hash shuffle on other keys every task holds rows of every
    partition value, so a plain ``partitionBy`` writes tasks × values
    files.  The ``REBALANCE`` hint shuffles once on the partition columns
    (about one file per value) and lets AQE split a partition that is
    larger than the advisory size — a month holding a third of the rows
    is written by several tasks — and merge small ones.  Unlike range
    partitioning it needs no sampling pass over the (re-executed) input.
    """
    w = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def clustered_rewrite(df: DataFrame, path: str, by: list[str], key: list[str],
                      partitions: int | None = None) -> None:
    """Co-locate rows by ``by`` (range partitioning + in-file sort), so
    Parquet min/max statistics let filters on these columns skip row
    groups and files — the open-source counterpart of Z-ordering or a
    clustering key.  The ranges end in the primary ``key``, so one hot value
    of ``by`` is spread over several files."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *by, *key).sortWithinPartitions(*by, *key)
       .write.mode("overwrite").parquet(path))


# ── co-location by several columns ───────────────────────────────────────────

ZORDER_BITS = 8                 # 256 quantile ranks of each column
SAMPLE_ROWS = 100_000           # rows that the quantiles are taken from


def _rank(column: str, bounds: list, low: int = 0, high: int | None = None):
    """Number of ``bounds`` at or below the column, as a balanced decision tree."""
    high = len(bounds) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return (F.when(F.col(column) < F.lit(bounds[middle]), _rank(column, bounds, low, middle))
            .otherwise(_rank(column, bounds, middle + 1, high)))


def quantile_bounds(df: DataFrame, columns: list[str], bits: int = ZORDER_BITS) -> dict[str, list]:
    """Column → its distinct quantiles, ascending (2**bits - 1 at most).

    The quantiles come from a bounded sample: they decide how even the layout is, never
    which rows it holds."""
    whole = df.select(*columns)
    share = min(1.0, 2.0 * SAMPLE_ROWS / max(1, whole.count()))
    sample = whole.sample(share, seed=1).limit(SAMPLE_ROWS).toPandas()
    out = {}
    for c in columns:
        values = sorted(v for v in sample[c].tolist() if v is not None and v == v)
        n = 2 ** bits
        out[c] = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    return out


def quantile_ranks(df: DataFrame, columns: list[str], bits: int = ZORDER_BITS,
                   bounds: dict[str, list] | None = None) -> dict:
    """Column → expression of its quantile rank (0 to 2**bits - 1; NULL ranks 0)."""
    bounds = bounds or quantile_bounds(df, columns, bits)
    return {c: F.when(F.col(c).isNull(), 0).otherwise(_rank(c, bounds[c])).cast("long") for c in columns}


def upper_half(column: str, bounds: list, bits: int = ZORDER_BITS) -> Column:
    """Highest bit of the column's rank, as one comparison."""
    half = 2 ** (bits - 1)
    if len(bounds) < half:
        return F.lit(False)
    return F.coalesce(F.col(column) >= F.lit(bounds[half - 1]), F.lit(False))


def interleaved(ranks: list, bits: int = ZORDER_BITS):
    """Bits of the ranks in turn, the first column's highest bit first."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for j, rank in enumerate(ranks):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(bit, i * len(ranks) + len(ranks) - 1 - j))
    return out


def _halves(df: DataFrame, by: str, bounds: list, partitions: int) -> list[tuple[DataFrame, int]]:
    """Parts of a large table in the order of the interleaved key's first bit, that of the
    first column, with their shares of the partitions."""
    from bankmart.session import is_large
    if not is_large(df):
        return [(df, partitions)]
    upper = upper_half(by, bounds)
    rows, above = df.select(upper.alias("_b")).agg(F.count(F.lit(1)), F.count_if("_b")).first()
    parts = [(df.where(part), max(1, round(partitions * n / rows)))
             for part, n in ((~upper, rows - above), (upper, above)) if n]
    return parts or [(df, partitions)]


def zorder_rewrite(df: DataFrame, path: str, by: list[str], key: list[str],
                   partitions: int | None = None) -> None:
    """Co-locate rows by all columns of ``by`` at once: rows are dealt into ranges of a
    key made of the bits of their quantile ranks in turn, so every file covers a narrow
    range of each column and filters on any one of them skip files and row groups.
    Ranges end in ``by`` and the primary ``key``, so a hot value is spread over files.
    A large table is dealt in two parts of the key, one after the other, so one part's
    shuffle files are on disk at once (under :func:`bankmart.session.shuffles_freed`)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = quantile_bounds(df, by)
    # ranks are columns of their own, so the key's bits do not repeat their expressions
    ranks = {f"_rank_{c}": rank for c, rank in quantile_ranks(df, by, bounds=bounds).items()}
    order = ["_z", *by, *key]
    for i, (part, share) in enumerate(_halves(df, by[0], bounds[by[0]], n)):
        (part.withColumns(ranks).withColumn("_z", interleaved([F.col(r) for r in ranks])).drop(*ranks)
             .repartitionByRange(share, *order).sortWithinPartitions(*order).drop("_z")
             .write.mode("append" if i else "overwrite").parquet(path))


# ── compaction ───────────────────────────────────────────────────────────────

def files_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file: path and bytes (contents are not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path)
            .select("path", F.col("length").alias("bytes")))


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """File count and bytes of a Parquet table (files without rows included)."""
    return files_of(spark, path).agg(F.count(F.lit(1)).alias("file_count"),
                                     F.sum("bytes").alias("total_bytes"),
                                     F.max("bytes").alias("max_file_bytes"))


def pack(sizes: list[int], target: int) -> list[int]:
    """First fit decreasing: a bin number per size.  No bin of several files exceeds
    ``target`` and at most one bin is under half of it."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    room: list[int] = []
    out = [0] * len(sizes)
    for i in order:
        bin_ = next((b for b, r in enumerate(room) if r >= sizes[i]), None)
        if bin_ is None:
            bin_ = len(room)
            room.append(target)
        out[i] = bin_
        room[bin_] -= sizes[i]
    return out


def compaction_plan(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Small files (under half of the target) that share a bin with another: path, folder, bin.
    Packed per folder, one folder at a time in a task; files of half the target or more
    are left alone."""
    small = files_of(spark, path).where(F.col("bytes") < target_bytes // 2).withColumn(
        "folder", F.regexp_replace("path", "/[^/]*$", ""))

    def packed(frame):
        frame = frame.sort_values(["bytes", "path"], ascending=[False, True])
        frame["bin"] = pack(frame["bytes"].tolist(), target_bytes)
        return frame[frame["bin"].map(frame["bin"].value_counts()) > 1][["path", "folder", "bin"]]

    return small.groupBy("folder").applyInPandas(packed, "path string, folder string, bin int")


def compact(spark: SparkSession, path: str, by: list[str] = (), target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Merge the small files of a table's folders, bin by bin, into files of up to about
    ``target_bytes``; larger files are neither read nor written.  Returns the number
    of files written.  A bin is a task of its own job, so no row is shuffled.

    After it every folder has at most one file under half of the target (of the bytes
    before compaction; one file's columns compress better than many files' do), and none
    of the new ones is above it by more than a tenth.

    New files are written beside the table (``_compaction``), then moved in, then the small
    ones are deleted.  A failure before the moves leaves the table as it was; readers
    should not list the table during the moves.

    The older form ``compact(spark, path, copy, by)`` leaves the table and writes a compacted copy."""
    from bankmart.session import delete_folder, input_bytes, run_concurrently
    if isinstance(by, str):
        copy, columns = by, [] if isinstance(target_bytes, int) else list(target_bytes)
        files = max(1, -(-input_bytes(spark, [path]) // (TARGET_FILE_BYTES if columns else target_bytes)))
        if columns:
            write_partitioned_balanced(spark.read.parquet(path), copy, columns)
        else:
            spark.read.parquet(path).repartition(files).write.mode("overwrite").parquet(copy)
        return files
    beside = f"{path}/_compaction"
    bins: dict[tuple, list[str]] = {}
    for r in compaction_plan(spark, path, target_bytes).collect():     # names of small files only
        bins.setdefault((r["folder"], r["bin"]), []).append(r["path"])
    if not bins:
        return 0
    delete_folder(spark, beside)

    def merge(number: int, files: list[str]) -> None:
        # files given by name have no partition columns; one task reads them and writes one file
        spark.read.parquet(*files).coalesce(1).write.parquet(f"{beside}/{number}")

    run_concurrently([(lambda i=i, files=sorted(files): merge(i, files)) for i, files in enumerate(bins.values())],
                     spark.sparkContext.defaultParallelism)
    moved = 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    for i, (folder, number) in enumerate(bins):
        for part in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{beside}/{i}")):
            name = part.getPath().getName()
            if not name.endswith(".parquet"):
                continue
            target = jvm.org.apache.hadoop.fs.Path(folder, f"bin-{number}-{name}")
            if not fs.rename(part.getPath(), target):
                raise OSError(f"cannot move {part.getPath()} to {target}")
            moved += 1
    old = [f for files in bins.values() for f in files]
    for f in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f), False)
    delete_folder(spark, beside)
    return moved
