"""N-gram language model in a sharded Elias-Fano trie.

Tokens are white-space separated words (A-Z lower-cased) and one end per text;
n-grams do not cross texts.  The trie's first level lists the training words by
hash; an entry of level k is a word after a context, and a context is an entry of level
k - 1.  Shards hold whole subtrees: a shard takes the words of one range of
hashes and all that follows them, so any level can be searched within the shard
of the first word.  Per level and shard one file holds

* ``keys``: Elias-Fano code of ``context * V + word`` (word numbers follow the
  hashes), searched by successor relative to the context;
* ``pointers``: Elias-Fano code of the monotone first positions of the contexts;
* one byte per entry: the discounted probability on a logarithmic scale;
* one byte per context: the weight of the shorter context, likewise;
* on the first level exact counts instead of probabilities.

The probability of a word is its discounted share in the longest context
plus that context's weight times the probability in the next shorter one
(absolute discounting, interpolated); the shortest is
``(c + 0.1) / (N + 0.1 (V + 1))``.  Files lie in the shared folder and are
memory-mapped by the tasks.  Shards number about one for each 2 million training tokens.

Counting is distributed: tasks sort the keys of some million tokens, and send
them per shard as compressed differences with counts; one group per shard
merges them and writes the level's file.

Defined cases: a null or empty text is its end alone; without training rows N
and V are 0 and every token has probability 1 in both scores; repeated rows
count each; a null doc_id counts as the empty text for the split; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import (crc32_text, documents, hashed_words, mapped_path, shared_folder,
                                 staged, utf8_column, write_once)

ORDER = 3
END = 0x1D8AF066B1F2C3A5          # stands for the end of a text among the word hashes
SHARD_TOKENS = 2_000_000
SLICE_BYTES = 4 << 20
CHUNK = 3 << 20                   # tokens sorted at a time
BLOCK = 2                         # 64-bit words per directory block
#: place of the i-th one (0 to 7) of a byte
_IN_BYTE = np.array([([p for p in range(8) if b >> p & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


# --- Elias-Fano ------------------------------------------------------------

def _bits_to_words(positions: np.ndarray, size: int) -> np.ndarray:
    words = np.zeros((size + 63) // 64 + 1, np.uint64)
    np.bitwise_or.at(words, positions >> 6, np.uint64(1) << (positions & 63).astype(np.uint64))
    return words


def ef_encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Non-decreasing values below ``universe`` as Elias-Fano arrays."""
    n = len(values)
    low_bits = max(0, (universe // max(1, n)).bit_length() - 1)
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low_bits)).astype(np.int64)
    size = n + (universe >> low_bits) + 2
    size += -size % (64 * BLOCK)
    upper = _bits_to_words(high + np.arange(n), size)[:size // 64]
    ones = np.bitwise_count(upper).reshape(-1, BLOCK).sum(1).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(ones)])
    low = np.zeros((n * low_bits + 63) // 64 + 2, np.uint64)
    if low_bits:
        part = values & np.uint64((1 << low_bits) - 1)
        at = np.arange(n, dtype=np.int64) * low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(low, word, part << shift)
        over = np.flatnonzero((at & 63) + low_bits > 64)
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
    return {"upper": upper, "before": before, "low": low,
            "shape": np.array([n, low_bits, universe >> low_bits], np.int64)}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.upper, self.before, self.low = arrays["upper"], arrays["before"], arrays["low"]
        self.n, self.low_bits, self.top = (int(x) for x in arrays["shape"])

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one (or zero) of the upper bits, from 0."""
        ahead = self.before if one else np.arange(len(self.before)) * (64 * BLOCK) - self.before
        block = np.searchsorted(ahead, k, "right") - 1
        words = self.upper.reshape(-1, BLOCK)[block]
        if not one:
            words = ~words
        counts = np.bitwise_count(words)
        rest, word = k - ahead[block], np.zeros(len(k), np.int64)
        left = np.ones(len(k), bool)
        for i in range(BLOCK - 1):                 # words that end before it
            left &= counts[:, i] <= rest
            rest -= np.where(left, counts[:, i], 0)
            word += left
        w = words[np.arange(len(k)), word]
        at = np.zeros(len(k), np.int64)
        for half in (32, 16, 8):                   # narrow down to the byte
            lower = np.bitwise_count(w & np.uint64((1 << half) - 1)).astype(np.int64)
            right = lower <= rest
            rest -= lower * right
            step = right * half
            at += step
            w = w >> step.astype(np.uint64)
        at += _IN_BYTE[(w & np.uint64(255)).astype(np.int64), rest]
        return block * (64 * BLOCK) + word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        spill = self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63))
        value |= np.where(shift > 0, spill, np.uint64(0))
        return value & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each value, or -1."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        x = x.astype(np.uint64)
        high = np.minimum((x >> np.uint64(self.low_bits)).astype(np.int64), self.top)
        want = x & np.uint64((1 << self.low_bits) - 1)
        # values with these upper bits are the ones between two zeros
        place = np.zeros(len(x), np.int64)
        some = high > 0
        place[some] = self._select(high[some] - 1, False) + 1
        out = np.full(len(x), -1, np.int64)
        rows, at = np.arange(len(x)), place - high
        for _ in range(4):                         # mostly a few
            bit = (self.upper[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
            rows, at, place = rows[bit], at[bit], place[bit]
            low = self._low(at)
            same = low == want[rows]
            out[rows[same]] = at[same]
            on = low < want[rows]
            rows, at, place = rows[on], at[on] + 1, place[on] + 1
        if len(rows):                              # else halve what is left
            end = self._select(high[rows], False) - high[rows]
            lo, hi, want = at, end.copy(), want[rows]
            while len(open_ := np.flatnonzero(lo < hi)):
                mid = (lo[open_] + hi[open_]) >> 1
                less = self._low(mid) < want[open_]
                lo[open_] = np.where(less, mid + 1, lo[open_])
                hi[open_] = np.where(less, hi[open_], mid)
            ok = np.flatnonzero(lo < end)
            ok = ok[self._low(lo[ok]) == want[ok]]
            out[rows[ok]] = lo[ok]
        return out


# --- level files -----------------------------------------------------------

def quantise(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per probability, and the 256 values (logarithmic steps)."""
    if not len(p):
        return np.empty(0, np.uint8), np.zeros(256)
    log = np.log(np.maximum(p, 1e-12))
    lo, hi = log.min(), max(log.max(), log.min() + 1e-9)
    return np.rint((log - lo) / (hi - lo) * 255).astype(np.uint8), np.exp(lo + np.arange(256) / 255 * (hi - lo))


def write_level(out, arrays: dict[str, np.ndarray]) -> None:
    head, at, bodies = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = (a.dtype.str, len(a), at)
        bodies.append(raw + b"\0" * (-len(raw) % 64))
        at += len(bodies[-1])
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    out.write(struct.pack("<q", len(text)) + text)
    for b in bodies:
        out.write(b)


class Level:
    """A memory-mapped level file of one shard."""

    def __init__(self, uri: str):
        body = np.asarray(np.memmap(mapped_path(uri), np.uint8, "r")).view(np.ndarray)
        size = struct.unpack("<q", body[:8].tobytes())[0]
        self.arrays = {}
        for name, (kind, n, at) in json.loads(body[8:8 + size].tobytes()).items():
            at += 8 + size
            self.arrays[name] = body[at:at + n * np.dtype(kind).itemsize].view(kind)
        part = lambda p: EliasFano({k[len(p):]: v for k, v in self.arrays.items() if k.startswith(p)})
        self.keys = part("keys_")
        self.pointers = part("pointers_") if "pointers_shape" in self.arrays else None

    def successors(self, context: int) -> tuple[int, int]:
        """Entries [from, to) of a context."""
        lo, hi = self.pointers.access(np.array([context, context + 1]))
        return int(lo), int(hi)


def _ef(prefix: str, values, universe) -> dict[str, np.ndarray]:
    return {prefix + k: v for k, v in ef_encode(values, universe).items()}


def context_level(keys: np.ndarray, counts: np.ndarray, contexts: int, vocabulary: int) -> dict[str, np.ndarray]:
    """Arrays of a level from its sorted keys ``context * V + word`` and counts."""
    context = (keys // np.uint64(max(1, vocabulary))).astype(np.int64)
    successors = np.bincount(context, minlength=contexts)
    total = np.bincount(context, counts, minlength=contexts)
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
    alpha, alphas = quantise((counts - discount) / total[context])
    weight, weights = quantise(discount * successors / np.maximum(total, 1))
    return {**_ef("keys_", keys, contexts * vocabulary + 1),
            **_ef("pointers_", np.concatenate([[0], np.cumsum(successors)]), len(keys) + 1),
            "alpha": alpha, "alphas": alphas, "weight": np.where(successors > 0, weight, 0).astype(np.uint8),
            "weights": weights, "has": np.packbits(successors > 0, bitorder="little")}


def _pack(a: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64)[:, 0]


def _merged(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.cumsum(_unpack(b)) for b in frame["keys"]])
    counts = np.concatenate([_unpack(b).astype(np.int64) for b in frame["counts"]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(counts, heads)


# --- the model on the executors ----------------------------------------------

class Trie:
    """Levels known so far: ``files[k][shard]`` is a path or None; ``base`` the
    number of words before each shard.  Pickles small; maps files on use."""

    def __init__(self, files, base, tokens, vocabulary, shards):
        self.files, self.base, self.tokens, self.vocabulary, self.shards = files, base, tokens, vocabulary, shards

    _open: dict[str, Level] = {}

    def level(self, k: int, shard: int) -> Level | None:
        path = self.files[k - 1][shard]
        if path is None:
            return None
        if path not in Trie._open:
            Trie._open[path] = Level(path)
        return Trie._open[path]

    def _by_shard(self, shard: np.ndarray):
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in range(self.shards):
            if cuts[s] < cuts[s + 1]:
                yield s, order[cuts[s]:cuts[s + 1]]

    def words(self, hashes: np.ndarray):
        """(shard, entry or -1, count) of word hashes."""
        bits = self.shards.bit_length() - 1
        shard = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        entry, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        rest = (hashes << np.uint64(bits)) >> np.uint64(bits + 1)
        for s, rows in self._by_shard(shard):
            level = self.level(1, s)
            if level is None:
                continue
            found = level.keys.find(rest[rows])
            hit = found >= 0
            entry[rows] = found
            count[rows[hit]] = level.arrays["count"][found[hit]]
        return shard, entry, count

    def after(self, k: int, shard: np.ndarray, context: np.ndarray, word: np.ndarray):
        """(entry or -1, discounted probability, weight of the shorter context)
        of words (-1: unknown) after contexts of level k - 1."""
        entry, alpha, weight = (np.full(len(shard), -1, np.int64), np.zeros(len(shard)), np.ones(len(shard)))
        for s, rows in self._by_shard(shard):
            level = self.level(k, s)
            if level is None:
                continue
            c = context[rows]
            has = (level.arrays["has"][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
            rows, c = rows[has], c[has]
            weight[rows] = level.arrays["weights"][level.arrays["weight"][c]]
            known = word[rows] >= 0
            rows, c = rows[known], c[known]
            found = level.keys.find(c.astype(np.uint64) * np.uint64(self.vocabulary) + word[rows].astype(np.uint64))
            entry[rows] = found
            hit = found >= 0
            alpha[rows[hit]] = level.arrays["alphas"][level.arrays["alpha"][found[hit]]]
        return entry, alpha, weight

    def walk(self, tokens: np.ndarray, first: np.ndarray, upto: int):
        """For each token of texts (``first``: start of each text): its count, the entry
        (shard, index or -1) of the k-gram that ends there for each k <= upto,
        and its smoothed probability from contexts shorter than ``upto``."""
        unique, back = np.unique(tokens, return_inverse=True)
        shard, entry, count = self.words(unique)
        word = np.where(entry >= 0, entry + np.asarray(self.base)[shard], -1)[back]
        p = ((count + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))[back]
        count, shard, entry = count[back], shard[back], entry[back]
        starts = np.zeros(len(tokens), bool)
        starts[first] = True
        levels = [(shard, entry)]
        base = p
        for k in range(2, upto + 1):
            before_shard, before = (np.concatenate([[0], x[:-1]]) for x in levels[-1])
            rows = np.flatnonzero((before >= 0) & ~starts)
            # equal (context, word) pairs are looked up once
            one = [before_shard[rows], before[rows], word[rows]]
            span = (int(one[1].max(initial=0)) + 1) * (self.vocabulary + 1)
            if span * self.shards < 2**64:           # sorted by shard, context and word
                code = (one[0].astype(np.uint64) * np.uint64(span)
                        + one[1].astype(np.uint64) * np.uint64(self.vocabulary + 1) + (one[2] + 1).astype(np.uint64))
                code, inverse = np.unique(code, return_inverse=True)
                part, code = np.divmod(code, np.uint64(span))
                context, code = np.divmod(code, np.uint64(self.vocabulary + 1))
                one = [part.astype(np.int64), context.astype(np.int64), code.astype(np.int64) - 1]
            else:
                inverse = np.arange(len(rows))
            found, alpha, weight = self.after(k, *one)
            entry = np.full(len(tokens), -1, np.int64)
            entry[rows] = found[inverse]
            p = p.copy()
            p[rows] = alpha[inverse] + weight[inverse] * p[rows]
            levels.append((before_shard, entry))
        return count, word, levels, base, p


def _tokens(batch):
    """Slices of a batch: rows, token hashes with ends, first token of each text."""
    body, offsets = utf8_column(batch.column("text"))
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        words, first = hashed_words(body[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        words = words & ~np.uint64(1)               # the lowest bit is not used
        words = np.insert(words, first[1:], np.uint64(END & ~1))
        yield batch.slice(a, b - a), words, first[:-1] + np.arange(b - a), first[1:] - first[:-1] + 1
        a = b


def _level_steps(k: int, shared, folder: str):
    """The counting of level ``k`` in a task, and the writing of one shard."""
    def count_level(batches):
        known, _ = shared.value
        held, size = [], 0

        def flush():
            shard, key = (np.concatenate(x) for x in zip(*held))
            for s, rows in known._by_shard(shard):
                keys, counts = np.unique(key[rows], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([s]), pa.array([_pack(np.diff(keys, prepend=np.uint64(0)))], pa.binary()),
                    pa.array([_pack(counts)], pa.binary())], ["shard", "keys", "counts"])

        for batch in batches:
            for _, words, first, _ in _tokens(batch):
                _, word, levels, _, _ = known.walk(words, first, k - 1)
                shard, entry = (np.concatenate([[0], x[:-1]]) for x in levels[-1])
                ok = entry >= 0
                ok[first] = False
                held.append((shard[ok], entry[ok].astype(np.uint64) * np.uint64(known.vocabulary)
                             + word[ok].astype(np.uint64)))
                size += len(words)
                if size >= CHUNK:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def next_level(key, frame):
        known, sizes = shared.value
        s = int(key[0])
        keys, counts = _merged(frame)
        arrays = context_level(keys, counts, sizes[s], known.vocabulary)
        path = write_once(folder, f"level{k}-{s}", lambda out: write_level(out, arrays))
        return pd.DataFrame({"shard": [s], "path": [f"{folder}/{path}"], "entries": [len(keys)]})

    return count_level, next_level


def train(docs: DataFrame, learn: Column, order: int = ORDER) -> Trie:
    spark = docs.sparkSession
    texts = docs.filter(learn).select("text")
    folder = shared_folder(spark, "ngram-trie")

    def count_words(batches):
        held = []

        def flush():
            w, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], ["word", "count"])

        for batch in batches:
            for _, words, _, _ in _tokens(batch):
                held.append(words)
                if sum(map(len, held)) >= CHUNK:
                    yield flush()
                    held = []
        if held:
            yield flush()

    counted = staged(texts.mapInArrow(count_words, "word long, count long").groupBy("word")
                     .agg(F.sum("count").alias("count")), "ngram-words")
    n, v = counted.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    shards = 1 << max(0, (n // SHARD_TOKENS).bit_length())
    bits = shards.bit_length() - 1
    shard = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")

    def first_level(key, frame):
        words = np.sort(frame["word"].to_numpy().view(np.uint64))
        place = np.argsort(frame["word"].to_numpy().view(np.uint64))
        rest = (words << np.uint64(bits)) >> np.uint64(bits + 1)
        arrays = {**_ef("keys_", rest, 1 << (63 - bits)), "count": frame["count"].to_numpy()[place]}
        path = write_once(folder, f"level1-{int(key[0])}", lambda out: write_level(out, arrays))
        return pd.DataFrame({"shard": [int(key[0])], "path": [f"{folder}/{path}"], "entries": [len(words)]})

    made = "shard long, path string, entries long"
    # one row per shard comes back
    rows = staged(counted.withColumn("shard", shard).groupBy("shard").applyInPandas(first_level, made),
                  "ngram-level").collect()
    files, entries = [[None] * shards], [0] * shards
    for r in rows:
        files[0][r["shard"]], entries[r["shard"]] = r["path"], r["entries"]
    base = np.concatenate([[0], np.cumsum(entries)])[:-1].tolist()
    trie = Trie(files, base, int(n), int(v), shards)

    for k in range(2, order + 1):
        shared = spark.sparkContext.broadcast((trie, entries))     # paths and sizes of the shards

        count_level, next_level = _level_steps(k, shared, folder)
        rows = staged(texts.mapInArrow(count_level, "shard long, keys binary, counts binary")
                      .groupBy("shard").applyInPandas(next_level, made), "ngram-level").collect()
        files, entries = [*trie.files, [None] * shards], [0] * shards
        for r in rows:
            files[-1][r["shard"]], entries[r["shard"]] = r["path"], r["entries"]
        trie = Trie(files, base, int(n), int(v), shards)
    return trie


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(trie)

    def judge(batches):
        known = shared.value
        order = len(known.files)
        for batch in batches:
            for rows, words, first, size in _tokens(batch):
                count, _, _, base, p = known.walk(words, first, order)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array(size), pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
                    pa.array(np.full(len(size), known.tokens)),
                    pa.array(np.add.reduceat(np.log10(base), first)),
                    pa.array(np.add.reduceat(np.log10(p), first))],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        judge, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc32_text(F.col("doc_id")) % 10 == 0
    scored = staged(score(docs, train(docs, ~held_out)), "ngram-scores")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")
