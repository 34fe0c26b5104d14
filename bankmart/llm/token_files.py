"""Token ids in seekable compressed files.

A shard file holds one independent zstandard frame per document (its ids as
little-endian unsigned 32-bit integers), then a skippable frame with the
documents' ids (a present flag byte and a signed 64-bit integer each), then the
seek table, a skippable frame at the end of the file:

    per frame: compressed size, decompressed size, checksum (uint32 each;
               the checksum is the low half of XXH64 of the decompressed bytes)
    footer:    number of frames (uint32), descriptor 0x80, magic 0x8F92EAB1

The last entry of the seek table is the frame of document ids (decompressed
size 0, checksum of its bytes).  A reader takes the table from the end of the
file and then reads and decompresses only the frames it wants.

Documents are range-partitioned by (doc_id, hash of the text) and each
partition writes one shard, so shards and documents within them ascend.
Shards are written under attempt-private names; the manifest (Parquet) lists
the files of the tasks that were committed, so retried tasks do no harm.

Defined cases: a null text is empty and has the end id alone; a null doc_id
comes first; repeated doc_ids follow one another by text hash; an empty table
gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import documents, open_fs, shared_folder, staged, worker_cache, write_once

END_ID = 2
SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_TOKENIZERS: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


#: chunks kept per worker process (until another operator's task releases them), and the
#: longest chunk that is kept (bytes)
MEMO_CHUNKS, MEMO_LENGTH = 1_000_000, 64
_MEMO: dict[str, dict[bytes, bytes]] = worker_cache()
_WORD_ENDS: dict[str, np.ndarray] = {}


def _word_ends(path: str) -> np.ndarray:
    """Which ids end a piece (the vocabulary marks them with a suffix)."""
    if path not in _WORD_ENDS:
        tk = _tokenizer(path)
        suffix = tk.model.end_of_word_suffix
        ends = np.zeros(tk.get_vocab_size(), bool)
        if suffix:
            ends[[i for piece, i in tk.get_vocab().items() if piece.endswith(suffix)]] = True
        _WORD_ENDS[path] = ends
    return _WORD_ENDS[path]


def _encode_chunks(chunks: list[bytes], path: str) -> list[bytes]:
    """Ids of each chunk by itself.  Chunks of letters alone are one piece
    each, so a row of them is encoded as one text and cut where pieces end; if
    the pieces don't number the chunks, each is encoded alone."""
    tk, ends = _tokenizer(path), _word_ends(path)
    texts = [c.decode("utf-8", "surrogatepass") for c in chunks]
    out: list[bytes | None] = [None] * len(chunks)
    plain = [i for i, t in enumerate(texts) if t.isalpha()]
    for a in range(0, len(plain), 512):
        part = plain[a:a + 512]
        # the batch form computes no offsets
        row = tk.encode_batch_fast([" ".join([texts[i] for i in part])], add_special_tokens=False)[0]
        ids = np.array(row.ids, "<u4")
        cut = np.flatnonzero(ends[ids]) + 1
        if len(cut) == len(part) and cut[-1] == len(ids):
            raw, at = ids.tobytes(), 0
            for i, to in zip(part, (cut * 4).tolist()):
                out[i] = raw[at:to]
                at = to
    alone = [i for i, x in enumerate(out) if x is None]
    for i, e in zip(alone, tk.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)):
        out[i] = np.array(e.ids, "<u4").tobytes()
    return out


def _ends_in_letter(c: bytes) -> bool:
    return c[-1:].isalpha() or (c[-1:] > b"\x7f" and c.decode("utf-8", "replace")[-1].lower().isalpha())


def _chunks(text: str) -> list[bytes]:
    """White-space separated chunks, A-Z lower-cased where that cannot change
    the ids: the tokenizer composes (NFC), then lowers; both forms must be
    composed already, and hold no start of a special token."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    if b"<|" not in raw and (raw.isascii() or (
            unicodedata.is_normalized("NFC", text)
            and unicodedata.is_normalized("NFC", low.decode("utf-8", "surrogatepass")))):
        return low.split()
    return raw.split()


def _gaps(got: list) -> list[int]:
    """Places of None."""
    out, at = [], -1
    try:
        while True:
            at = got.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


def encode_ids(texts: list[str], path: str, end_id: int) -> list[bytes]:
    """Ids of each text with the end id, as little-endian uint32 bytes.

    The tokenizer never joins characters across ASCII white space (its
    pre-tokenizer drops white space; composition does not cross it), so a
    text's ids are those of its white-space separated chunks in a row, and a
    chunk seen before need not be encoded again; punctuation after a letter is
    a piece of its own.  A worker's memory of chunks is bounded and started
    afresh when full."""
    memo = _MEMO.setdefault(path, {})
    if len(memo) > MEMO_CHUNKS:
        memo.clear()
    chunks = [_chunks(t) for t in texts]
    got = [list(map(memo.get, c)) for c in chunks]
    gaps = [_gaps(g) for g in got]
    missing = {c[i] for c, places in zip(chunks, gaps) for i in places}
    if missing:
        cores = {w: w.rstrip(b".,;:!?") for w in missing}
        cores = {w: c if c != w and _ends_in_letter(c) else w for w, c in cores.items()}
        tails = {w[len(c):] for w, c in cores.items()}
        fresh = [x for x in {*cores.values(), *tails} if x in missing or x and x not in memo]
        new = dict(zip(fresh, _encode_chunks(fresh, path)))
        for w, c in cores.items():
            if c != w:
                tail = w[len(c):]
                new[w] = (new.get(c) or memo[c]) + (new.get(tail) or memo[tail])
        for c, g, places in zip(chunks, got, gaps):
            for i in places:
                g[i] = new[c[i]]
        memo.update((w, x) for w, x in new.items() if len(w) <= MEMO_LENGTH)
    end = np.array([end_id], "<u4").tobytes()
    return [b"".join(g) + end for g in got]


class ShardWriter:
    """Writes frames as documents arrive; only the seek table is held."""

    def __init__(self, out, level: int = 1):
        import zstandard
        self.out, self.entries, self.ids, self.tokens = out, [], [], 0
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """``raw``: the document's ids as little-endian uint32 bytes."""
        import xxhash
        frame = self.compress(raw)
        self.out.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(raw) // 4

    def close(self) -> None:
        import xxhash
        body = b"".join(struct.pack("<Bq", i is not None, i or 0) for i in self.ids)
        self.out.write(struct.pack("<II", SKIPPABLE_IDS, len(body)) + body)
        self.entries.append((len(body) + 8, 0, xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), 0x80, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table)


class ShardReader:
    """Random access to the documents of one shard file."""

    def __init__(self, fsys, path: str):
        self.file = fsys.open_input_file(path)
        end = self.file.size()
        n, descriptor, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEK_MAGIC or descriptor != 0x80:
            raise ValueError(f"{path}: no seek table")
        self.entries = np.frombuffer(self.file.read_at(12 * n, end - 9 - 12 * n), "<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        body = self.file.read_at(int(self.entries[-1, 0]) - 8, int(self.at[n - 1]) + 8)
        self._check(body, n - 1)
        flags = np.frombuffer(body, np.dtype([("known", "u1"), ("id", "<i8")]))
        self.ids = [int(i) if known else None for known, i in flags]

    def _check(self, raw: bytes, i: int) -> None:
        import xxhash
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries[i, 2]:
            raise ValueError(f"frame {i}: checksum differs")

    def __len__(self) -> int:
        return len(self.ids)

    def read(self, i: int) -> np.ndarray:
        """Token ids of the i-th document; reads and decompresses its frame alone."""
        import zstandard
        frame = self.file.read_at(int(self.entries[i, 0]), int(self.at[i]))
        size = int(self.entries[i, 1])
        raw = zstandard.ZstdDecompressor().decompress(frame, max_output_size=size)
        self._check(raw, i)
        return np.frombuffer(raw, "<u4")

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID,
                 partitions: int | None = None) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text); returns the manifest
    (shard, part, n_docs, n_tokens), one row per shard file."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    folder = shared_folder(spark, "tokens")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = (keyed.repartitionByRange(partitions, *order) if partitions
              else keyed.repartitionByRange(*order)).sortWithinPartitions(*order)
    ranged = ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def write(frames):
        state, rows = {}, iter(frames)

        def body(out):
            writer = ShardWriter(out)
            for f in rows:
                if not len(f):
                    continue
                state.setdefault("part", int(f["part"].iloc[0]))
                known = f["doc_id"].notna().to_numpy()
                ids = f["doc_id"].to_numpy()
                texts = f["text"].tolist()
                for a in range(0, len(texts), 256):
                    for j, tokens in enumerate(encode_ids(texts[a:a + 256], tokenizer, end_id), a):
                        writer.add(int(ids[j]) if known[j] else None, tokens)
            writer.close()
            state["writer"] = writer

        first = next((f for f in rows if len(f)), None)
        if first is None:
            return
        import itertools
        rows = itertools.chain([first], rows)
        name = write_once(folder, "shard", body)
        w = state["writer"]
        yield pd.DataFrame({"shard": [f"{folder}/{name}"], "part": [state["part"]],
                            "n_docs": [len(w.ids)], "n_tokens": [w.tokens]})

    return staged(ranged.mapInPandas(write, "shard string, part int, n_docs long, n_tokens long"),
                  "token-manifest")


def read_tokens(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard, frame) of every document of
    the shards in ``manifest`` - or of the ``wanted`` doc_ids alone, in which
    case only their frames are read.  ``start`` counts the ids of all documents
    before it."""
    # one row per shard file; their count grows with the partitions only
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    shards = max(1, manifest.count())

    def read(frames):
        for f in frames:
            for path, base in zip(f["shard"], f["base"]):
                fsys, p = open_fs(path)
                reader = ShardReader(fsys, p)
                sizes = reader.entries[:-1, 1].astype(np.int64) // 4
                start = int(base) + np.cumsum(sizes) - sizes
                rows = range(len(reader)) if wanted is None else [
                    i for i, d in enumerate(reader.ids) if d in wanted]
                crcs = [zlib.crc32(reader.read(i)) for i in rows]
                rows = list(rows)
                yield pd.DataFrame({
                    "doc_id": pd.array([reader.ids[i] for i in rows], "Int64"),
                    "start": start[rows], "n_tokens": sizes[rows], "ids_crc32": np.array(crcs, np.int64),
                    "shard": path, "frame": np.array(rows, np.int32)})
                reader.close()

    return based.repartition(shards, "part").mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard string, frame int")


def op1(spark, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(documents(spark, sf_dir))).drop("shard", "frame")
