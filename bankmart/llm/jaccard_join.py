"""Exact n-gram Jaccard join with token-combination prefixes.

A document's set is its distinct 5-word shingles (64-bit hashes; words are
white-space separated, A-Z lower-cased; with fewer words the whole sequence is
one shingle).  Documents with equal sets form a class; classes are joined.

1. *Token counts.*  Every shingle of every document is counted: tasks sort the
   leading 40 bits of their shingles, cut them into ranges and send each range
   as compressed differences; one group per range merges them.  Shingles with a
   count of ``frequent`` or more form the frequent class.  (The counts only
   choose an order and skip single shingles; two shingles that agree in
   40 bits count as one, which changes no result.)
2. *Signatures.*  In the final order shingles that occur once come first, as far as
   a bitmap of fixed size tells them, then the other rare ones, frequent ones last; so
   texts that share passages but are mostly their own meet in no bucket.  A set whose prefix is all rare is indexed by its prefix, token by
   token.  A set whose prefix reaches into the frequent class is indexed by all
   its rare shingles and by pairs of frequent ones: its prefix is extended by
   ``B`` shingles, frequent shingles are dealt into ``B`` parts by hash and
   every two of one part make a signature.  Linked sets share at least B + 1
   shingles of their extended prefixes, so if all of these are frequent, two
   of them meet in one part.  B depends on a size class; linked sets lie in the
   same or neighbouring classes, so each set is indexed for its own class and
   the one below.
3. *Verification in rounds.*  Signatures that occur once are dropped (the bitmap
   keeps most of them from being shuffled; it may let single ones pass, never drops a
   repeated one).  First each set is
   verified against one partner, the smallest of the bucket it meets
   most often; the verified links give components.  Sets of buckets that still hold
   several components are then grouped by combinations of two least shingles, which
   linked sets probably share, and verified against one set of another component in each
   of their groups, as long as that merges components.  At last the buckets produce
   their remaining pairs across components (exact: no link depends on the groups), so
   a large group of linked copies costs a few verifications each.  Similar texts that do
   not link are compared in all pairs of a bucket, but make a pair once and not in every
   bucket they share: each set names a few landmarks among its buckets, and two sets that
   agree in landmarks meet in the first such bucket only (in all, if they agree in none).
   Parity bits rule pairs of short texts out before whole sets are read.
4. *Components* come from large star / small star rounds.

Every bucket is handled whole: nothing is capped or dropped.

Defined cases: null or empty text and white space only give the empty set,
which is linked with nothing (its component is its own doc_id); a null doc_id
is never the smallest unless alone; repeated rows are copies of each other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import (SPACE_WORD, discard, documents, hashed_words, mapped_path, mix64, release_memory, shared_folder,
                                 shingle_sets, staged, utf8_column, worker_cache, write_once)
from bankmart.llm.components import stars, with_roots

SHARE = (3, 4)                    # similarity threshold as a fraction
FREQUENT = 8                      # a shingle in so many documents is of the frequent class
MAX_FREQUENT = 2_000_000          # those of them that tasks know (16 MB); others count as rare
MERGE_ROUNDS = 3                  # rounds by combinations of least shingles before all remaining pairs
COMBINATIONS = 8                  # combinations of two least shingles of a set
BITMAP_BITS = 27                  # size of the repeated-signature bitmap (16 MB)
PARITY_WORDS = 16                 # 64-bit words of a set's parity bits
LANDMARKS = 8                     # buckets that a set names, so that a pair is made once
SLICE_BYTES = 1 << 20
COUNT_BITS = 40                   # leading bits of a shingle that are counted
COUNT_CHUNK = 1 << 20             # shingles sorted at a time


def _slices(batch):
    """Rows of an Arrow batch in slices of a few megabytes of text."""
    body, offsets = utf8_column(batch.column("text"))
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(a, b - a), body[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def _sets(body, offsets, k):
    return shingle_sets(*hashed_words(body, offsets), k)


def set_id(s: np.ndarray) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(s.tobytes(), seed=len(s)) - 2**63


def prefix_length(n: int) -> int:
    return n - (-(-n * SHARE[0] // SHARE[1])) + 1


def _size_bounds() -> np.ndarray:
    """Lower bounds of size classes: a set and one at most 4/3 as large lie in
    the same or neighbouring classes."""
    out = [1, 2]
    while out[-1] < 2**40:
        out.append(max(out[-1] + 1, (out[-1] - 1) * SHARE[1] // SHARE[0] + 1))
    return np.array(out)


BOUNDS = _size_bounds()


def signatures(s: np.ndarray, frequent: np.ndarray, bitmap: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of a set (sorted hashes), and for each how many more shingles
    can be shared if it is the first shared one: those after it in the final
    order; for a pair of frequent ones all other frequent ones (two sets that
    share no rare shingle share frequent ones only); and which are pairs.
    Shingles that are not in ``bitmap`` occur once, so they come first."""
    n = len(s)
    length = prefix_length(n)
    if len(frequent):
        lead = s >> np.uint64(64 - COUNT_BITS)
        at = np.searchsorted(frequent, lead)
        often = frequent[np.minimum(at, len(frequent) - 1)] == lead
    else:
        often = np.zeros(n, bool)
    rare = s[~often]
    if bitmap is not None:
        again = _in_bitmap(bitmap, rare)
        rare = np.concatenate([rare[~again], rare[again]])
    if length <= len(rare):
        return rare[:length], n - 1 - np.arange(length), np.zeros(length, bool)
    heavy = s[often]
    keys, after = [rare], [n - 1 - np.arange(len(rare))]
    own = int(np.searchsorted(BOUNDS, n, "right")) - 1
    for tag in {own, max(0, own - 1)}:
        parts = max(1, int(BOUNDS[tag]) // 4)
        part_of = heavy[:min(n, length + parts) - len(rare)]
        part = mix64(part_of + np.uint64(tag)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        part, part_of = part[order], part_of[order]
        step = 1
        while True:
            same = np.flatnonzero(part[step:] == part[:-step])
            if not len(same):
                break
            a, b = part_of[same], part_of[same + step]
            key = mix64(mix64(a + np.uint64(2 * tag + 1)) ^ b)
            keys.append(key)
            after.append(np.full(len(key), len(heavy) - 1))
            step += 1
    keys = np.concatenate(keys)
    return keys, np.concatenate(after), np.arange(len(keys)) >= len(rare)


def count_blobs(tokens: np.ndarray, ranges: int):
    """(range, blob) of sorted leading bits, as byte planes of differences."""
    import zstandard
    lead = np.sort(tokens >> np.uint64(64 - COUNT_BITS))
    bounds = np.array([(i << COUNT_BITS) // ranges for i in range(ranges + 1)], np.uint64)
    cuts = np.searchsorted(lead, bounds)
    pack = zstandard.ZstdCompressor(level=1).compress
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            steps = np.diff(lead[a:b], prepend=bounds[i])
            yield i, pack(steps.view(np.uint8).reshape(-1, 8)[:, :COUNT_BITS // 8].T.tobytes())


def merge_blobs(i: int, blobs, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading bits that occur more than once in a range, and their counts."""
    import zstandard
    unpack = zstandard.ZstdDecompressor().decompress
    parts = []
    for blob in blobs:
        planes = np.frombuffer(unpack(blob), np.uint8).reshape(COUNT_BITS // 8, -1)
        steps = np.zeros((planes.shape[1], 8), np.uint8)
        steps[:, :COUNT_BITS // 8] = planes.T
        parts.append(np.cumsum(steps.view(np.uint64)[:, 0]) + np.uint64((i << COUNT_BITS) // ranges))
    lead, count = np.unique(np.concatenate(parts), return_counts=True)
    return lead[count > 1], count[count > 1]


def _write_array(df: DataFrame, column: str, folder: str, name: str, fill) -> str:
    """Write one bounded array that ``fill(batches)`` makes in a single task."""
    def put(array):
        return f"{folder}/{write_once(folder, name, lambda out: out.write(array.tobytes()))}"

    def write(batches):
        yield pa.RecordBatch.from_pydict({"path": [put(fill(batches))]})

    rows = df.coalesce(1).mapInArrow(write, "path string").collect()
    return rows[0]["path"] if rows else put(fill([]))        # an empty table may have no task


_MAPPED: dict[str, np.ndarray] = worker_cache()


def _mapped(uri: str, dtype) -> np.ndarray:
    if uri not in _MAPPED:
        import os
        path = mapped_path(uri)
        _MAPPED[uri] = (np.memmap(path, dtype, "r") if os.path.getsize(path)
                        else np.empty(0, dtype))
    return _MAPPED[uri]


def _can_link(n, after, m, after_m):
    """False where sizes or positions rule a link out."""
    a, b = SHARE
    return ((b * F.least(n, m) >= a * F.greatest(n, m))
            & ((a + b) * (F.least(after, after_m) + 1) >= a * (n + m)))


def parity_bits(s: np.ndarray) -> np.ndarray:
    """Bit ``h`` tells whether an odd number of the set's shingles fall on it, so
    two sets differ in at least as many shingles as bits."""
    bits = np.bincount((s % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def combinations(s: np.ndarray) -> np.ndarray:
    """Shingles dealt by their last bits, the least of each part, two parts at a time: equal
    sets agree in all, similar ones probably in some.  0: both parts are empty."""
    part, at = np.unique(s % np.uint64(2 * COMBINATIONS), return_index=True)
    least = np.zeros(2 * COMBINATIONS, np.uint64)
    least[part.astype(np.int64)] = s[at]                 # the set is sorted
    a, b = least[::2], least[1::2]
    return np.where((a | b) == 0, np.uint64(0), mix64(mix64(a + np.uint64(1)) ^ b)).view(np.int64)


def _in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _write_bitmap(df: DataFrame, column: str, folder: str, name: str) -> str:
    """A bitmap of fixed size with the leading bits of every key set: a filter
    that lets all of the keys pass, and few others while they are few."""
    words = df.groupBy(F.shiftrightunsigned(column, 70 - BITMAP_BITS).alias("word")).agg(F.bit_or(F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - BITMAP_BITS}) & 63 as int))")).alias("bits"))

    def fill(batches):
        bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
        for b in batches:
            bitmap[b.column("word").to_numpy(zero_copy_only=False)] = b.column("bits").to_numpy(zero_copy_only=False)
        return bitmap

    return _write_array(words, "word", folder, name, fill)


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b: set ids) that link, from the whole sets."""
    wanted = (pairs.join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("sb")), "b")
              .join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("sa")), "a")
              .select("a", "b", "sa", "sb"))

    def verify(batches):
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            keep = []
            for x, y in zip(sa, sb):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                inter = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                union = len(x) + len(y) - inter
                keep.append(SHARE[1] * inter >= SHARE[0] * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return wanted.mapInArrow(verify, "a long, b long").distinct()


def _open_buckets(entries: DataFrame, label: DataFrame) -> DataFrame:
    """Entries of the buckets that hold several components, each with its component and the
    (component, sid, n) of the bucket's lowest and of its highest component."""
    placed = (entries.join(label.withColumnRenamed("node", "sid"), "sid", "left")
              .withColumn("component", F.coalesce("component", "sid")))
    entry = F.struct("component", "sid", "n")
    ends = placed.groupBy("key").agg(F.min(entry).alias("lo"), F.max(entry).alias("hi")).filter(
        "lo.component <> hi.component")
    return placed.join(ends, "key")


def _differ(x: str, y: str):
    """In how many parity bits the sets of two columns differ."""
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
                for i in range(PARITY_WORDS)), F.lit(0))


def _near(n, m, differ):
    """False where so many differing shingles rule a link out."""
    return 2 * SHARE[0] * (n + m) <= sum(SHARE) * (n + m - differ)


def _landmarks(entries: DataFrame) -> DataFrame:
    """The least key of each set in each of ``LANDMARKS`` parts of the keys, with the largest
    sum of sizes up to which its position lets sets link: sid, mark0, reach0, mark1, ..."""
    a, b = SHARE
    part = F.pmod("key", F.lit(LANDMARKS))
    least = entries.groupBy("sid").agg(*[F.min(F.when(part == i, F.struct("key", "after"))).alias(f"least{i}")
                                         for i in range(LANDMARKS)])
    return least.select("sid", *[c for i in range(LANDMARKS) for c in (
        F.col(f"least{i}.key").alias(f"mark{i}"),
        F.floor((a + b) * (F.col(f"least{i}.after") + 1) / a).alias(f"reach{i}"))])


def _meet_first(x: str, y: str):
    """False where the sets of two entries of a bucket meet in an earlier landmark: of the landmarks
    they agree in and whose position lets them link, the first is their only bucket."""
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    agreed = [F.when((F.col(f"{x}.mark{i}") == F.col(f"{y}.mark{i}"))
                     & (F.least(f"{x}.reach{i}", f"{y}.reach{i}") >= both), F.col(f"{x}.mark{i}"))
              for i in range(LANDMARKS)]
    return F.coalesce(*agreed, F.col(f"{x}.key")) == F.col(f"{x}.key")


def last_pairs(entries: DataFrame, partitions: int) -> DataFrame:
    """Pairs (a < b) of sets of different components that share a bucket and may link.
    ``entries``: key, sid, n, after, component, parity and the landmarks."""
    # few bytes but many comparisons: dealt by key over all tasks, however small
    dealt = entries.repartition(partitions, "key").hint("merge")
    x, y = dealt.alias("x"), dealt.alias("y")
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.sid") < F.col("y.sid"))
                   & (F.col("x.component") != F.col("y.component"))
                   & _can_link(F.col("x.n"), F.col("x.after"), F.col("y.n"), F.col("y.after"))
                   & _meet_first("x", "y")
                   & _near(F.col("x.n"), F.col("y.n"), _differ("x.parity", "y.parity")))
    return cross.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))


def jaccard_components(docs: DataFrame, k: int = 5, frequent: int = FREQUENT) -> dict[str, DataFrame]:
    """``classes`` (doc_id, n_shingles, sid, component_id) with one row per row
    of ``docs``, ``members`` (doc_id, mark, n, sid) likewise with the hash of each
    row's text, ``label`` (sid, component) of the linked sets, and ``links`` (a, b)
    between set ids: spanning links that join each component, not all of its pairs."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")

    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def describe(batches):
        release_memory()
        tokens, held, seen = [], 0, set()

        def flush():
            for i, blob in count_blobs(np.concatenate(tokens), ranges):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64())), pa.array([i], pa.int32()), pa.array([blob], pa.binary())], names)

        names = ["doc_id", "mark", "n", "sid", "parity", "combined", "range", "blob"]
        for batch in batches:
            for rows, body, offsets in _slices(batch):
                sets = _sets(body, offsets, k)
                ids = [set_id(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), rows.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array([parity_bits(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    pa.array([combinations(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary())], names)
                for s, i in zip(sets, ids):
                    if i is not None and i not in seen:    # copies nearby count once
                        seen.add(i)
                        tokens.append(s)
                        held += len(s)
                if held >= COUNT_CHUNK:
                    yield from flush()
                    tokens, held, seen = [], 0, set()
        if tokens:
            yield from flush()
        del tokens
        release_memory()

    described = staged(texts.withColumn("mark", F.xxhash64("text")).mapInArrow(
        describe, "doc_id long, mark long, n long, sid long, parity array<long>, combined array<long>, range int, blob binary"),
        "jaccard-members")
    members = described.filter("range is null").select("doc_id", "mark", "n", "sid")
    reps = members.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"))

    def merge(key, frame):
        import pandas as pd
        lead, count = merge_blobs(int(key[0]), frame["blob"], ranges)
        return pd.DataFrame({"lead": lead.astype(np.int64), "count": count})

    counted = staged(described.filter("range is not null").select("range", "blob")
                     .groupBy("range").applyInPandas(merge, "lead long, count long"), "jaccard-counts")
    folder = shared_folder(spark, "jaccard-files")
    often = counted.filter(F.col("count") >= frequent).orderBy(F.desc("count"), "lead").limit(MAX_FREQUENT)

    def gather(batches):
        tokens = [b.column("lead").to_numpy(zero_copy_only=False) for b in batches]
        return np.sort(np.concatenate(tokens).view(np.uint64)) if tokens else np.empty(0, np.uint64)

    often_file = _write_array(often.select("lead"), "lead", folder, "frequent", gather)
    repeated_file = _write_bitmap(counted.select(F.shiftleft("lead", 64 - COUNT_BITS).alias("key")),
                                  "key", folder, "repeated")

    def index(batches):
        """Signatures of every set, without single shingles."""
        heavy, bitmap = _mapped(often_file, np.uint64), _mapped(repeated_file, np.uint64)
        for batch in batches:
            for _, body, offsets in _slices(batch):
                sets = [s for s in _sets(body, offsets, k) if len(s)]
                if not sets:
                    continue
                found = [signatures(s, heavy, bitmap) for s in sets]
                keys = np.concatenate([f[0] for f in found])
                count = [len(f[0]) for f in found]
                columns = [keys.view(np.int64),
                           np.repeat(np.array([set_id(s) for s in sets], np.int64), count),
                           np.repeat(np.array([len(s) for s in sets], np.int64), count),
                           np.concatenate([f[1] for f in found]).astype(np.int64)]
                hit = _in_bitmap(bitmap, keys) | np.concatenate([f[2] for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(c[hit]) for c in columns],
                                                 ["key", "sid", "n", "after"])
        release_memory()

    posted = texts.mapInArrow(index, "key long, sid long, n long, after long")
    # one row per bucket and class (a class's copies meet before the shuffle)
    bucket = Window.partitionBy("key")
    entries = staged(
        posted.groupBy("key", "sid").agg(F.first("n").alias("n"), F.max("after").alias("after"))
        .withColumn("hub", F.min(F.struct("sid", "n", "after")).over(bucket))
        .withColumn("size", F.count("*").over(bucket)).filter("size > 1")
        .select("key", "sid", "n", "after", F.col("hub.sid").alias("a"), F.col("hub.n").alias("na"),
                F.col("hub.after").alias("aftera")), "jaccard-entries")

    def whole_sets(named: DataFrame) -> DataFrame:
        """Whole sets (sid, shingles) of the documents that stand for the
        classes ``named`` (sid); a few others may be among them."""
        wanted_file = _write_bitmap(reps.join(named, "sid", "left_semi").select(
            F.xxhash64("rep").alias("place")), "place", folder, "wanted")

        def collect_sets(batches):
            wanted = _mapped(wanted_file, np.uint64)
            for batch in batches:
                places = batch.column("place").to_numpy(zero_copy_only=False).view(np.uint64)
                batch = batch.filter(pa.array(_in_bitmap(wanted, places)))
                for _, body, offsets in _slices(batch):
                    sets = [s for s in _sets(body, offsets, k) if len(s)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([set_id(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary())], ["sid", "shingles"])
            release_memory()

        return staged(texts.withColumn("place", F.xxhash64("doc_id")).mapInArrow(
            collect_sets, "sid long, shingles binary"), "jaccard-sets")

    # round one: one partner each
    starred = entries.filter((F.col("sid") != F.col("a"))
                             & _can_link(F.col("n"), F.col("after"), F.col("na"), F.col("aftera")))
    one = (starred.groupBy("a", F.col("sid").alias("b")).count()
           .groupBy("b").agg(F.max(F.struct("count", (-F.col("a")).alias("m"))).alias("best"))
           .select((-F.col("best.m")).alias("a"), "b"))
    tried = staged(one, "jaccard-pairs")
    sets = whole_sets(tried.select(F.explode(F.array("a", "b")).alias("sid")).distinct())
    links = staged(_links(tried, sets), "jaccard-links")
    discard(sets)
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    label = stars(links, "a", "b")

    # further rounds: sets of open buckets, grouped by combinations of least shingles, each
    # against one set of another component; buckets of one component are done
    held = staged(_open_buckets(entries.select("key", "sid", "n", "after"), label)
                  .select("key", "sid", "n", "after"), "jaccard-placed")
    discard(entries)
    about = staged(described.filter("n > 0").join(held.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("combined").alias("combined")),
        "jaccard-about")
    parities, sets = about.select("sid", "parity"), None
    def joined(label: DataFrame, found: DataFrame) -> DataFrame:
        """The components so far, as links of each node to its smallest, and more links."""
        return label.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(found)

    grouped = about.select("sid", "n", F.posexplode("combined").alias("place", "part")).filter("part <> 0").select(
        F.xxhash64("place", "part").alias("key"), "sid", "n")
    for _ in range(MERGE_ROUNDS):
        mine = F.col("component") == F.col("lo.component")
        met = _open_buckets(grouped, label).withColumn("o", F.when(mine, F.col("hi")).otherwise(F.col("lo")))
        pair = met.select(F.least("sid", "o.sid").alias("a"), F.greatest("sid", "o.sid").alias("b"),
                          (F.col("n") + F.col("o.n")).alias("both"), F.least("n", "o.n").alias("less")).distinct()
        near = (pair.filter(SHARE[1] * F.col("less") >= SHARE[0] * (F.col("both") - F.col("less")))
                .join(tried, ["a", "b"], "left_anti")
                .join(parities.toDF("a", "pa"), "a").join(parities.toDF("b", "pb"), "b")
                .filter(_near(F.col("both"), F.lit(0), _differ("pa", "pb"))))
        next_ = staged(near.select("a", "b"), "jaccard-pairs")
        if next_.isEmpty():
            break
        if sets is None:
            sets = whole_sets(about.select("sid"))
        found = staged(_links(next_, sets), "jaccard-links")
        tried = tried.unionByName(next_)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        label = stars(joined(label, found), "a", "b")

    # last round: the remaining pairs across components, in buckets that hold several
    open_ = staged(_open_buckets(held, label).drop("lo", "hi").join(parities, "sid").join(_landmarks(held), "sid"),
                   "jaccard-open")
    discard(held)
    rest = last_pairs(open_, int(spark.conf.get("spark.sql.shuffle.partitions"))).distinct()
    rest = staged(rest.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
    discard(open_)
    if not rest.isEmpty():
        if sets is None:
            sets = whole_sets(rest.select(F.explode(F.array("a", "b")).alias("sid")).distinct())
        found = staged(_links(rest, sets), "jaccard-links")
        links = links.unionByName(found)
        if not found.isEmpty():
            label = stars(joined(label, found), "a", "b")
    if sets is not None:
        discard(sets)
    discard(about)
    label = with_roots(label).withColumnRenamed("node", "sid")

    named = members.select("doc_id", "n", "sid").join(label, "sid", "left")
    smallest = (reps.join(label, "sid").groupBy("component").agg(F.min("rep").alias("least")))
    classes = (named.join(smallest, "component", "left").join(reps, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "sid",
        F.coalesce("least", "rep", "doc_id").alias("component_id")))
    return {"classes": classes, "members": members, "label": label, "links": links}


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest
    (doc_id, hash of the text) stays, a null doc_id last; of repeated rows, one.
    Rows without shingles are linked with nothing and all stay."""
    found = jaccard_components(docs)
    members = found["members"].filter("sid is not null")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    # copies meet before the join, so that a large class is one row there
    kept = (members.groupBy("sid").agg(F.min(row).alias("least")).join(found["label"], "sid", "left")
            .groupBy(F.coalesce("component", "sid").alias("component")).agg(F.min("least").alias("least"))
            .select("least.doc_id", "least.mark"))
    alone = found["members"].filter("sid is null").select("doc_id", "mark").distinct()
    own = docs.alias("d").join(
        kept.unionByName(alone).alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
        & (F.xxhash64("d.text") == F.col("k.mark")), "left_semi")
    # only repeated rows can leave more than one behind
    repeated = members.groupBy("doc_id", "mark").count().filter("count > 1").limit(1).count()
    if not repeated:
        return own
    worded = F.coalesce(F.col("text").rlike(SPACE_WORD), F.lit(False))
    return own.filter(worded).dropDuplicates(["doc_id", "text"]).unionByName(own.filter(~worded))


def op8(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))["classes"].drop("sid")
