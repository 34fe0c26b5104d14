"""Shared helpers: staged tables, shared files, hashed words in numpy."""

from __future__ import annotations

import gc
import os
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.session import delete_folder, scratch_path

#: white space of the word rules: space, tab, line feed, VT, FF, CR
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: rows that go to a Python worker at a time, so that batches of long texts fit
ARROW_ROWS = 1000
_ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage,
    survives lost executors).  Collecting the driver's garbage first lets Spark
    remove the shuffle files of earlier steps, which are no longer read."""
    spark = df.sparkSession
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    path, before = scratch_path(spark, name), spark.conf.get(_ARROW_CONF)
    spark.conf.set(_ARROW_CONF, str(min(ARROW_ROWS, int(before))))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ARROW_CONF, before)
    written = spark.read.schema(df.schema).parquet(path)
    written.staged_path = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete staged tables after their last reader."""
    for df in tables:
        delete_folder(df.sparkSession, df.staged_path)


def open_fs(uri: str):
    """(pyarrow file system, path) of a folder or file below the shared folder."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder, created, as a URI or path."""
    path = scratch_path(spark, name)
    fsys, p = open_fs(path)
    fsys.create_dir(p, recursive=True)
    return path


def write_once(folder: str, name: str, write) -> str:
    """Write a file under an attempt-private name and move it into place;
    returns its final name (a retried task writes a file of its own, and only
    the committed task's rows name it)."""
    fsys, base = open_fs(folder)
    final = f"{name}-{uuid.uuid4().hex[:12]}"
    tmp = f"{base}/_{final}.tmp"
    with fsys.open_output_stream(tmp) as out:
        write(out)
    fsys.move(tmp, f"{base}/{final}")
    return final


def crc32_text(doc_id: Column) -> Column:
    """crc32 of doc_id as text; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def utf8_column(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array (null: empty), no copies
    of single texts."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.type != pa.large_string():
        array = array.cast(pa.large_string())
    if array.null_count:
        array = pc.fill_null(array, "")
    n = len(array)
    _, off, data = array.buffers()
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, np.int64, n + 1, array.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return body[off[0]:off[-1]], off - off[0]


# --- hashed words ---------------------------------------------------------
# A word's hash is the polynomial sum of per-byte random 64-bit values modulo
# 2**64, taken from one running sum over the bytes, then mixed.

_ODD = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CHUNK = 1 << 19
_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, _CHUNK + 4096)
        inverse = pow(_ODD, -1, 2**64)
        out = []
        for base in (_ODD, inverse):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POW[:] = out
    return _POW[0][:n], _POW[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hashed_words(body: np.ndarray, offsets: np.ndarray,
                 lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all white-space separated words (A-Z lower-cased, if ``lower``) of
    the texts ``body[offsets[i]:offsets[i+1]]``, and the index of each text's
    first word (length: texts + 1).  Works in pieces of about half a megabyte
    that end between words."""
    n = len(body)
    space = _IS_SPACE[body] if n else np.empty(0, bool)
    begins = np.zeros(n + 1, bool)           # a word may not span two texts
    begins[offsets[:-1]] = True
    hashes, firsts = [], []
    if n:
        word = ~space
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = word[:-1]
        starts = np.flatnonzero(word & (~before | begins[:n]))
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = word[1:] & ~begins[1:n]
        ends = np.flatnonzero(word & ~after) + 1
        del word, before, after
        i = 0
        while i < len(starts):
            lo = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, lo + _CHUNK, "right")))
            hi = ends[j - 1]
            power, inverse = _powers(int(hi - lo))
            total = np.empty(hi - lo + 1, np.uint64)
            total[0] = 0
            np.cumsum((_BYTE_LOWER if lower else _BYTE)[body[lo:hi]] * power, out=total[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            hashes.append(mix64((total[e] - total[s]) * inverse[s]
                                + (e - s).astype(np.uint64)))
            i = j
        firsts = np.searchsorted(starts, offsets)
    else:
        firsts = np.zeros(len(offsets), np.int64)
    out = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return out, firsts.astype(np.int64)


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per text: sorted distinct hashes of its k-word shingles; of a text with
    fewer words the whole sequence as one; empty without words."""
    total = len(words)
    full = max(0, total - k + 1)
    roll = np.empty(0, np.uint64)
    if full:
        roll = words[:full].copy()
        for j in range(1, k):
            roll = mix64(roll + np.uint64(j)) + words[j:full + j]
        roll = mix64(roll + np.uint64(k))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(roll[a:b - k + 1]))
        elif b > a:
            h = words[a:a + 1]
            for j in range(1, b - a):
                h = mix64(h + np.uint64(j)) + words[a + j:a + j + 1]
            out.append(mix64(h + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


_CACHES: list[dict] = []


def worker_cache() -> dict:
    """A dict that a worker process keeps between tasks until ``release_memory``."""
    _CACHES.append({})
    return _CACHES[-1]


def release_memory() -> None:
    """Give memory that a finished partition, or an earlier operator's tasks in this process,
    no longer use back to the system, as Python workers live on."""
    import ctypes
    import pyarrow as pa
    for cache in _CACHES:
        cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)         # freed blocks between used ones (glibc)
    except (OSError, AttributeError):
        pass


def is_local(path: str) -> bool:
    return path.startswith("file:") or "://" not in path


def mapped_path(uri: str) -> str:
    """A path that this process can memory-map: the file itself where the
    shared folder is mounted, else a copy fetched once per worker."""
    fsys, path = open_fs(uri)
    if is_local(uri):
        return path
    import tempfile
    local = os.path.join(tempfile.gettempdir(), f"mapped-{os.getpid()}-{os.path.basename(path)}")
    if not os.path.exists(local):
        with fsys.open_input_stream(path) as src, open(local + ".part", "wb") as out:
            while block := src.read(1 << 22):
                out.write(block)
        os.replace(local + ".part", local)
    return local
