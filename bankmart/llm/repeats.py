"""Exact removal of long repeats with a run-length index.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller
doc_id, or the same document and an earlier start) is removed; strings are
judged on the input.

1. *Anchors.*  Of the 32-byte grams in every window of ``LENGTH`` bytes the one
   with the smallest hash (leftmost of equals) is the window's anchor, so equal windows
   have equal anchors at equal offsets.  Consecutive windows with one anchor
   form a context.  Anchors that occur once are dropped: all are counted
   (compressed sorted hashes) and a bitmap of fixed size lets every repeated one pass.
2. *Equal contexts.*  All occurrences of a context but its first are covered
   whole; this settles copies and the inside of shared passages by one
   aggregation, whatever their number.
3. *Index.*  Anchors with several different contexts (borders of passages,
   edits) remain, once per context.  Their contexts are dealt into parts; each
   part gets a run-length index: a suffix order, the runs of its
   Burrows-Wheeler transform and samples at the run borders.  Longest matches are known at
   the sampled positions and stream on from there, one less per byte, to
   every other position; neighbours in suffix order with matches of
   ``LENGTH`` or more are equal windows, and all but the earliest are
   covered.  An anchor with more contexts than a part may hold is settled
   instead by the hashes of its windows, aggregated over the cluster.
4. The covered intervals of each document are merged and cut out.

Defined cases: null and empty texts have 0 bytes; texts shorter than ``LENGTH``
keep all; a null doc_id comes before all others; rows with one doc_id and
different texts are ordered by text hash, and rows alike in both are copies, of
which one is first; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import _powers, discard, documents, mix64, shared_folder, staged, utf8_column
from bankmart.llm.jaccard_join import (COUNT_BITS, COUNT_CHUNK, _in_bitmap, _mapped, _write_bitmap,
                                       count_blobs, merge_blobs)

LENGTH, GRAM = 100, 32
PIECE = 1 << 20                   # bytes of a document looked at together
PART_CONTEXTS = 4_000             # contexts of one index (about 0.7 MB), on average
CROWDED = 10_000                  # an anchor with more contexts is settled by window hashes
_POSITION = np.uint64((1 << 24) - 1)
_BYTE = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NULL_ID = -2**63


def contexts(text: np.ndarray, hashed: bool = True):
    """(anchor hash, start, windows, hash) arrays of a text's contexts; without
    ``hashed`` the last one is left at 0."""
    out = []
    for lo in range(0, max(0, len(text) - LENGTH + 1), PIECE):
        piece = text[lo:lo + PIECE + LENGTH - 1]
        values = _BYTE[piece]
        gram, size = values, 1
        while size < GRAM:                        # polynomial hashes by doubling
            gram = gram[:-size] * np.uint64(pow(0x9E3779B97F4A7C15, size, 2**64)) + gram[size:]
            size *= 2
        gram = mix64(gram)
        least = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
        width, full = 1, LENGTH - GRAM + 1
        while 2 * width <= full:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < full:
            least = np.minimum(least[:len(least) - (full - width)], least[full - width:])
        change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        windows = np.diff(change, append=len(least))
        anchor = gram[(least[change] & _POSITION).astype(np.int64)]
        if not hashed:
            out.append((anchor, change + lo, windows, np.zeros(len(anchor), np.uint64)))
            continue
        power, inverse = _powers(len(piece))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power)])
        end = change + windows + LENGTH - 1
        own = mix64((total[end] - total[change]) * inverse[change] + (end - change).astype(np.uint64))
        out.append((anchor, change + lo, windows, own))
    if not out:
        z = np.empty(0, np.int64)
        return np.empty(0, np.uint64), z, z, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def run_length_index(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``text`` (small integers; each separator unique and
    smaller than all bytes) and, in this order, the length of the match with
    the suffix before.  Match lengths are computed at the run borders of the
    Burrows-Wheeler transform only and streamed from there."""
    n = len(text)
    # the first order is by four symbols at once; later ones double
    bits = int(text.max(initial=0) + 1).bit_length()
    width = 4 if 4 * bits <= 62 else 1
    padded = np.concatenate([text + 1, np.zeros(width, np.int64)])
    rank = np.zeros(n, np.int64)
    for i in range(width):
        rank = (rank << bits) | padded[i:n + i]
    ranks, step = [], width
    while True:
        _, rank = np.unique(rank, return_inverse=True)
        ranks.append(rank)
        if rank.max(initial=0) == n - 1:
            break
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        rank = rank * (n + 1) + after
        step *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    bwt = text[order - 1]                          # position -1: the last separator
    border = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
    here, before = order[border], order[border - 1]
    match = np.zeros(len(border), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = here + match, before + match
        inside = (a < n) & (b < n)
        r = ranks[level]
        same = inside & (r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)]) & (here != before)
        match += np.where(same, width << level, 0)
    for _ in range(width - 1):                     # what is left is shorter than the first step
        a, b = here + match, before + match
        inside = (a < n) & (b < n) & (here != before)
        match += inside & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])
    match[0] = 0
    sampled = np.full(n, -1, np.int64)
    sampled[here] = match
    at = np.maximum.accumulate(np.where(sampled >= 0, np.arange(n), 0))
    streamed = np.maximum(sampled[at] - (np.arange(n) - at), 0)
    return order, streamed[order]


def earlier_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """Windows of a part's contexts that also start earlier in it, as
    (doc, mark, start, windows) runs."""
    m = len(frame)
    sizes = frame["body"].map(len).to_numpy()
    start = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.empty(start[-1], np.int64)
    owner = np.repeat(np.arange(m), sizes + 1)
    inner = np.arange(start[-1]) - start[owner]
    separator = inner == sizes[owner]
    text[~separator] = np.frombuffer(b"".join(frame["body"]), np.uint8).astype(np.int64) + m
    text[separator] = np.arange(m)
    order, match = run_length_index(text)
    group = np.cumsum(match < LENGTH)
    twin = match >= LENGTH
    twin[:-1] |= match[1:] >= LENGTH
    where, group = order[twin], group[twin]
    docs, marks = frame["doc"].to_numpy(), frame["mark"].to_numpy()
    begin = frame["start"].to_numpy()[owner[where]] + inner[where]
    line = np.lexsort((begin, marks[owner[where]], docs[owner[where]]))
    place = np.empty(len(line), np.int64)
    place[line] = np.arange(len(line))
    if not len(where):
        return pd.DataFrame({"doc": [], "mark": [], "start": [], "windows": []}, dtype="int64")
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    first = np.repeat(np.minimum.reduceat(place, heads), np.diff(heads, append=len(group)))
    late = np.sort(where[place > first])
    runs = np.flatnonzero(np.concatenate([[True], np.diff(late) > 1])) if len(late) else np.empty(0, np.int64)
    at = late[runs]
    return pd.DataFrame({"doc": docs[owner[at]], "mark": marks[owner[at]],
                         "start": frame["start"].to_numpy()[owner[at]] + inner[at],
                         "windows": np.diff(runs, append=len(late))})


def window_hashes(body: bytes) -> np.ndarray:
    values = _BYTE[np.frombuffer(body, np.uint8)]
    power, inverse = _powers(len(values))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power)])
    n = len(values) - LENGTH + 1
    return mix64((total[LENGTH:] - total[:n]) * inverse[:n])


def _placed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Texts with their place in the order: ``doc`` is doc_id (null: the smallest long), ``mark``
    the text hash, or 0 where no doc_id repeats; and whether one does."""
    doc = F.coalesce("doc_id", F.lit(_NULL_ID))
    repeated = bool(docs.groupBy(doc).count().filter("count > 1").limit(1).count())
    mark = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    return docs.select("doc_id", doc.alias("doc"), mark.alias("mark"), "text"), repeated


def _spot(own, doc, start):
    """An occurrence's place in a bitmap: its hash, moved by document and start."""
    return own ^ (doc << 37) ^ (start << 44)


def batch_copies(anchor, own, doc, mark, start) -> np.ndarray:
    """Per occurrence of one batch: how often its context occurs in the batch if it is the
    earliest there, 0 if it starts later, -1 for a repetition of the earliest one's row."""
    copies = np.ones(len(own), np.int64)
    line = np.argsort(own, kind="stable")
    same = own[line[1:]] == own[line[:-1]]
    again = line[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    if len(again):
        columns = (start[again], mark[again], doc[again], anchor[again], own[again])
        line = np.lexsort(columns)
        place, group = np.stack([c[line] for c in columns[:3]]), np.stack([c[line] for c in columns[3:]])
        head = np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(0)])
        heads = np.flatnonzero(head)
        first = np.repeat(heads, np.diff(heads, append=len(line)))
        repeated = (place == place[:, first]).all(0) & ~head
        found = np.where(repeated, -1, 0)
        found[heads] = np.add.reduceat((~repeated).astype(np.int64), heads)
        copies[again[line]] = found
    return copies


def covered(texts: DataFrame, repeated_ids: bool, part_contexts: int = PART_CONTEXTS, crowded_contexts: int = CROWDED) -> DataFrame:
    """(doc, mark, runs): per text of ``_placed`` the runs (start, windows) of window starts
    that also start earlier."""
    spark, texts = texts.sparkSession, texts.select("doc", "mark", "text")
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        held = []
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for a, b in zip(offsets[:-1], offsets[1:]):
                held.append(contexts(body[a:b], hashed=False)[0])
            if sum(map(len, held)) >= COUNT_CHUNK // 2:
                yield from _blob_rows(held)
                held = []
        if held:
            yield from _blob_rows(held)

    def _blob_rows(held):
        for i, blob in count_blobs(np.concatenate(held), ranges):
            yield pa.RecordBatch.from_pydict({"range": pa.array([i], pa.int32()), "blob": pa.array([blob], pa.binary())})

    def merge(key, frame):
        lead, n = merge_blobs(int(key[0]), frame["blob"], ranges)
        return pd.DataFrame({"lead": lead.astype(np.int64)})

    repeated = staged(texts.mapInArrow(count, "range int, blob binary").groupBy("range")
                      .applyInPandas(merge, "lead long"), "repeat-anchors")
    folder = shared_folder(spark, "repeat-files")
    anchors_file = _write_bitmap(repeated.select(F.shiftleft("lead", 64 - COUNT_BITS).alias("key")),
                                 "key", folder, "anchors")
    discard(repeated)

    def occurrences(batches, wanted_file=None):
        anchors = _mapped(anchors_file, np.uint64)
        wanted = _mapped(wanted_file, np.uint64) if wanted_file else None
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            found = {c: [] for c in ("anchor", "own", "doc", "mark", "start", "windows", "body")}
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "mark"))
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                text = body[a:b]
                anchor, start, windows, own = contexts(text)
                hit = _in_bitmap(anchors, anchor)
                if wanted is not None:
                    hit &= _in_bitmap(wanted, _spot(own.view(np.int64), ids[i], start).view(np.uint64))
                hit = np.flatnonzero(hit)
                if not len(hit):
                    continue
                for c, v in zip(found, (anchor.view(np.int64), own.view(np.int64), None, None, start, windows)):
                    if v is not None:
                        found[c].append(v[hit])
                found["doc"].append(np.full(len(hit), ids[i]))
                found["mark"].append(np.full(len(hit), marks[i]))
                if wanted is not None:
                    raw = text.tobytes()
                    found["body"] += [raw[s:s + w + LENGTH - 1] for s, w in zip(start[hit], windows[hit])]
            if found["doc"]:
                names = list(found)[:6]
                columns = [np.concatenate(found[c]).astype(np.int64) for c in names]
                if wanted is not None:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(found["body"], pa.binary())],
                                                     list(found))
                    continue
                copies = batch_copies(*columns[:5])
                keep = copies >= 0
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (*columns, copies)], [*names, "copies"])

    schema = "anchor long, own long, doc long, mark long, start long, windows long"
    # copies: occurrences of the context in its batch of texts, 0 if it is not the earliest there,
    # so that a context that is everywhere is one row per batch from here on
    found = staged(texts.mapInArrow(lambda b: occurrences(b), schema + ", copies long"), "repeat-occurrences")
    earliest_in_batch = found.filter("copies > 0")
    variants = Window.partitionBy("anchor")
    # dealt by anchor once, for both the contexts and their variants
    firsts = staged(
        earliest_in_batch.repartition("anchor").groupBy("anchor", "own").agg(F.min(F.struct("doc", "mark", "start")).alias("first"),
                                           F.sum("copies").alias("n"))
        .withColumn("variants", F.count("*").over(variants)).filter("n > 1 or variants > 1"), "repeat-contexts")
    run = ["doc", "mark", "start", "windows"]
    again = staged(earliest_in_batch.join(firsts.filter("n > 1").select("anchor", "own", "first"), ["anchor", "own"])
                   .filter(F.struct("doc", "mark", "start") != F.col("first")).select(*run)
                   .unionByName(found.filter("copies = 0").select(*run)), "repeat-copies")
    discard(found)

    varied = firsts.filter("variants > 1").select(
        "anchor", "own", "variants", F.col("first.doc").alias("doc"), F.col("first.mark").alias("mark"),
        F.col("first.start").alias("start"))
    spot = F.expr("own ^ shiftleft(doc, 37) ^ shiftleft(start, 44)")         # as _spot
    wanted_file = _write_bitmap(varied.select(spot.alias("spot")), "spot", folder, "contexts")
    bodies = texts.mapInArrow(lambda b: occurrences(b, wanted_file), schema + ", body binary")
    bodies = bodies.join(varied, ["anchor", "own", "doc", "mark", "start"])
    if repeated_ids:                                 # rows alike in doc and mark
        bodies = bodies.dropDuplicates(["anchor", "own"])
    bodies = staged(bodies, "repeat-bodies")
    discard(firsts)
    total = bodies.count()
    parts = max(1, -(-total // part_contexts))
    dealt = bodies.filter(F.col("variants") <= crowded_contexts).withColumn(
        "part", F.pmod(F.xxhash64("anchor"), F.lit(parts)))
    indexed = staged(dealt.select("part", "doc", "mark", "start", "body").groupBy("part").applyInPandas(
        lambda key, f: earlier_windows(f), "doc long, mark long, start long, windows long"), "repeat-windows")

    def explode_windows(batches):
        for batch in batches:
            for i, body in enumerate(batch.column("body").to_pylist()):
                h = window_hashes(body)
                one = [np.full(len(h), batch.column(c)[i].as_py()) for c in ("anchor", "doc", "mark", "start")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (one[0], h.view(np.int64), one[1], one[2],
                                                       one[3] + np.arange(len(h)))],
                    ["anchor", "window", "doc", "mark", "start"])

    crowded = bodies.filter(F.col("variants") > crowded_contexts).mapInArrow(
        explode_windows, "anchor long, window long, doc long, mark long, start long")
    earliest = crowded.groupBy("anchor", "window").agg(F.min(F.struct("doc", "mark", "start")).alias("first"),
                                                       F.count("*").alias("n")).filter("n > 1")
    spread = (crowded.join(earliest, ["anchor", "window"])
              .filter(F.struct("doc", "mark", "start") != F.col("first"))
              .select("doc", "mark", "start", F.lit(1).cast("long").alias("windows")))
    runs = again.unionByName(indexed).unionByName(spread)
    merged = staged(runs.groupBy("doc", "mark").agg(
        F.collect_list(F.struct("start", "windows")).alias("runs")), "repeat-runs")
    discard(again, bodies, indexed)
    return merged


def removed_spans(runs, n: int) -> np.ndarray:
    """Merged [start, end) byte spans of covered windows."""
    if runs is None or not len(runs):
        return np.empty((0, 2), np.int64)
    a = np.array([(r["start"], r["start"] + r["windows"] + LENGTH - 1) for r in runs], np.int64)
    a = a[np.argsort(a[:, 0], kind="stable")]
    end = np.maximum.accumulate(a[:, 1])
    new = np.concatenate([[True], a[1:, 0] > end[:-1]])
    heads = np.flatnonzero(new)
    return np.stack([a[heads, 0], end[np.append(heads[1:] - 1, len(a) - 1)]], 1)


def without_repeats(docs: DataFrame, part_contexts: int = PART_CONTEXTS,
                    crowded_contexts: int = CROWDED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept) per row of ``docs``;
    ``kept`` holds the remaining bytes (which may split a character)."""
    texts, repeated_ids = _placed(docs)
    runs = covered(texts, repeated_ids, part_contexts, crowded_contexts)
    alike = repeated_ids and texts.groupBy("doc", "mark").count().filter("count > 1").limit(1).count()
    joined = texts.join(runs, ["doc", "mark"], "left")
    joined = joined.withColumn("copy", F.row_number().over(
        Window.partitionBy("doc", "mark").orderBy(F.lit(1))) if alike else F.lit(1))

    def cut(batches):
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            rows = []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                raw, n = body[a:b].tobytes(), int(b - a)
                spans = removed_spans(batch.column("runs")[i].as_py(), n)
                if batch.column("copy")[i].as_py() > 1 and n >= LENGTH:
                    spans = np.array([[0, n]])
                edges = [0, *spans.ravel().tolist(), n]
                rows.append((n, int((spans[:, 1] - spans[:, 0]).sum()), len(spans), spans.tolist(),
                             b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return joined.select("doc_id", "text", "runs", "copy").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")


def op9(spark, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
