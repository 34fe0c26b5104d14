"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "bankmart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark.

    On a cluster the session comes from the platform; nothing in the
    library depends on these settings except through ``spark.conf``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Shared folder for written tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    folder); only when neither is set on a local master (tests) a private
    temporary folder is created once per application and registered as the
    checkpoint folder.  On any other master a missing setting is an error.
    """
    try:
        base = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 — some deployments reject reading core confs
        base = None
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    app = sc.applicationId
    if not base and app in _LOCAL_ROOTS:
        base = _LOCAL_ROOTS[app]
    if not base:
        base = sc.getCheckpointDir()
    if not base and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="bankmart-")
        sc.setCheckpointDir(_LOCAL_ROOTS[app])
        base = _LOCAL_ROOTS[app]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    path = f"{shared_root(spark)}/bankmart/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/"):
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return path


def partition_values(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """Names (after ``prefix``) of the sub-folders of ``base``, sorted.  Uses the
    cluster file system through the Hadoop API (metadata only)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def committed_subdirs(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """Like :func:`partition_values`, of sub-folders that hold a ``_SUCCESS`` marker.
    A folder left by a failed write has no marker and is ignored (and overwritten
    by the rerun)."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [v for v in partition_values(spark, base, prefix)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base}/{prefix}{v}/_SUCCESS"))]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster file system, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it a write deletes its shuffle files when it ends.  Else they stay until the
    driver happens to collect its garbage, and a job of several writes holds all of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def input_bytes(spark: SparkSession, paths) -> int:
    """Total bytes under ``paths`` from file-system metadata (no scan)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


SLICED_BYTES = 64 * 1024 * 1024         # larger inputs are shuffled in slices, one after the other


def is_large(df: DataFrame) -> bool:
    """Whether the files that ``df`` reads are worth shuffling in slices."""
    return input_bytes(df.sparkSession, set(df.inputFiles())) >= SLICED_BYTES


# sizing targets for one shuffle partition / one scan split
SHUFFLE_TARGET_BYTES = 512 * 1024 * 1024
SCAN_SPLIT_BYTES = 256 * 1024 * 1024
# in-memory rows are larger than compressed Parquet
EXPANSION = 3.0


def tune_for_input(spark: SparkSession, nbytes: int) -> dict:
    """Size shuffles and scan splits for an input of ``nbytes`` (Parquet).

    Sets runtime SQL options only: the initial shuffle partition count so a
    partition holds about 512 MB of expanded rows (AQE then coalesces the
    small ones and splits skewed ones toward the advisory size), 256 MB
    scan splits, and skew handling on.  Never below twice the cores.
    """
    cores = spark.sparkContext.defaultParallelism
    parts = max(2 * cores, -(-int(nbytes * EXPANSION) // SHUFFLE_TARGET_BYTES))
    settings = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TARGET_BYTES // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings


def run_concurrently(actions, at_once: int | None = None) -> list:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each, ``at_once`` at most) and return their results in order; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor
    from pyspark import inheritable_thread_target
    actions = list(actions)
    if len(actions) <= 1:
        return [a() for a in actions]
    # worker threads inherit the caller's job group / scheduler pool (and,
    # given the session, its job tags)
    active = SparkSession.getActiveSession()
    wrap = inheritable_thread_target(active) if active is not None else inheritable_thread_target
    call = wrap(lambda a: a())
    with ThreadPoolExecutor(max_workers=min(len(actions), at_once or len(actions))) as pool:
        return list(pool.map(call, actions))
