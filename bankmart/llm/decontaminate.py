"""Benchmark decontamination with SimHash windows, in DataFrame functions only.

Words are as in the license scan (A-Z lower-cased, runs of ASCII letters,
digits and non-ASCII characters); an item's weighted shingles are its 5-word
shingles with their counts.  A document leaks an item when some window of the
item's number of shingles has a weighted Jaccard similarity (sum of smaller
counts over sum of larger counts) of ``similarity`` or more with the item.

1. *Windows.*  A shingle that occurs in no item cannot add to any
   intersection.  A window can be moved on to its first shingle of the item
   without losing any, so the windows that count start at a shingle of the
   item, and hold at least ``similarity * size`` shingles of items at all.
2. *Fingerprints.*  Each such window and each item gets a 64-bit SimHash: the
   majority of its features' hash bits, where a shingle of weight w is w
   features (shingles of no item weigh nothing there).  The bit counts are summed in 32 packed columns.
3. *Multi-index Hamming blocks.*  Fingerprints are cut into 8 blocks of 8 bits.
   Two that differ in at most 23 bits have a block that differs in at most two,
   so items are listed under each block value and the 36 values within two bits,
   and an equi-join on (shingle length, size, block, value) finds every pair within the radius.
4. *Verification.*  The weighted similarity of each pair is computed exactly.

At similarity 0.75 the expected distance is about 8 of 64 bits (10, with a
deviation of 3, for the shortest items that can leak with a change, where ties
of the majority are common), so that a radius of 23 lets a leak in a million go;
the tests compare with brute force.

Defined cases: items and texts that are null, empty or without words take no part; an
item of fewer than five words is one shingle of all its words and leaks where
these words stand in a row (windows hold shingles of one length only, so that
short items which begin at one word don't mix); a null doc_id is a document like others; repeated items and documents count separately (one
result row per document row and item_id); empty tables give an empty
result; very long texts are cut into pieces and their hits into blocks, so memory does not
grow with a text's length; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import documents, staged
from bankmart.llm.licenses import words_of

K = 5
BLOCKS, BLOCK_BITS, RADIUS = 8, 8, 23
#: what a block may differ by: all masks of at most RADIUS // BLOCKS bits
MASKS = [sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1)
         for bits in combinations(range(BLOCK_BITS), n)]
LANES = 0x0000000100000001
#: words of a piece of text, and least places of a block of hits
PIECE, BLOCK_PLACES = 512, 128


def _gram(length: int):
    return F.xxhash64(F.lit(length), F.array(*[F.get("words", F.col("p") + i) for i in range(length)]))


def _fingerprint(rows: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash per key of rows (keys, hash, weight).  A shingle of weight w
    counts as w features, so that a few heavy shingles can't outvote each other by a
    hair; bit i + 32 j of a feature is counted in half j of column i."""
    features = rows.select(*keys, "hash", F.explode(F.sequence(F.lit(1).cast("long"), "weight")).alias("_i"))
    features = features.withColumn("_f", F.xxhash64("hash", "_i"))
    lanes = [F.sum(F.shiftrightunsigned("_f", i).bitwiseAND(F.lit(LANES))).alias(f"_c{i}") for i in range(32)]
    counted = features.groupBy(*keys).agg(F.count("*").alias("_w"), *lanes)
    bits = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"_c{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_c{i}", 32)
        bits = bits.bitwiseOR(F.when(2 * low > F.col("_w"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
        bits = bits.bitwiseOR(F.when(2 * high > F.col("_w"), F.shiftleft(F.lit(1).cast("long"), 32 + i))
                              .otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, bits.alias("print"))


def _block(column: str):
    return F.expr(
        f"cast(shiftrightunsigned({column}, block * {BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1} as int)")


def item_shingles(items: DataFrame) -> DataFrame:
    """(item, item_id, gram, size, hash, weight): counted shingles of each item
    row; ``gram`` is their number of words."""
    words = items.select(F.monotonically_increasing_id().alias("item"), "item_id",
                         words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    grams = F.when(F.size("words") >= K, _gram(K))
    for n in range(1, K):
        grams = F.when(F.size("words") == n, _gram(n)).otherwise(grams)
    at = words.select("item", "item_id", "words", F.least(F.size("words"), F.lit(K)).alias("gram"),
                      F.greatest(F.size("words") - K + 1, F.lit(1)).alias("size"),
                      F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - K, F.lit(0)))).alias("p"))
    return at.select("item", "item_id", "gram", "size", grams.alias("hash")).groupBy(
        "item", "item_id", "gram", "size", "hash").agg(F.count("*").alias("weight"))


def leaks(docs: DataFrame, items: DataFrame, similarity: float = 0.75,
          broadcast_shingles: int = 500_000) -> DataFrame:
    """(row, doc_id, item_id, similarity, start, size): the best window of each
    document row and item that leaks; ``start`` counts words from 0."""
    shingled = staged(item_shingles(items), "items")
    known = shingled.groupBy("hash").agg(F.collect_set("size").alias("sizes"))
    # benchmarks are small; a larger one is joined without a hint
    small = known.limit(broadcast_shingles + 1).count() <= broadcast_shingles
    known = F.broadcast(known) if small else known
    short = sorted(r[0] for r in items.select(F.size(words_of(F.col("text"))).alias("n"))
                   .filter(f"n between 1 and {K - 1}").distinct().collect())   # at most four values

    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                        words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    # a text is cut into pieces, so no row of a place carries more than one piece
    total = F.size("words")
    cut = F.transform(F.sequence(F.lit(0), F.floor((total - 1) / PIECE).cast("int")), lambda b: F.struct(
        (b * PIECE).alias("base"), F.slice("words", b * PIECE + 1, PIECE + K - 1).alias("words")))
    pieces = texts.select("row", "doc_id", total.alias("total"), F.explode(cut).alias("c")).select(
        "row", "doc_id", "total", "c.base", "c.words")
    at = pieces.select("row", "doc_id", "total", "base", "words", F.explode(
        F.sequence(F.lit(0), F.least(F.col("total") - F.col("base"), F.lit(PIECE)) - 1)).alias("p"))
    grams = [F.struct(F.when(F.col("p") + n <= F.size("words"), _gram(n)).alias("hash"), F.lit(n).alias("gram")) for n in [*short, K]]
    found = at.select("row", "doc_id", (F.col("base") + F.col("p")).alias("p"),
                      F.greatest(F.col("total") - K + 1, F.lit(1)).alias("n"),
                      *([grams[0]["hash"].alias("hash"), F.lit(K).alias("gram")] if len(grams) == 1
                        else [F.explode(F.array(*grams)).alias("g")]))
    if len(grams) > 1:
        found = found.select("row", "doc_id", "p", "n", "g.hash", "g.gram")
    hits = staged(found.filter("hash is not null").join(known, "hash")
                  .select("row", "doc_id", "p", "n", "gram", "hash", "sizes"), "decontamination-hits")

    # windows [p, p + size) that start at a hit and hold enough hits, for each
    # shingle length by itself (so at most one hit a place).  Hits go to blocks of
    # places, and those among the first places of a block to the block before as well,
    # so that a block has all of its windows; it holds as many places as the longest
    # item twice over, however long the text is
    longest = shingled.agg(F.max("size")).first()[0] or 1
    span = max(BLOCK_PLACES, longest)
    own = F.floor(F.col("p") / span).cast("long")
    shared_place = (F.col("p") >= span) & (F.col("p") % span < longest)
    per_block = hits.withColumn("at", F.explode(F.when(shared_place, F.array(own, own - 1)).otherwise(F.array(own)))).groupBy(
        "row", "doc_id", "gram", "at").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("p", "hash", "sizes"))).alias("h"))
    starts = per_block.select("row", "doc_id", "gram", "at", "n", "h", F.posexplode("h").alias("i", "s")).filter(
        F.floor(F.col("s.p") / span) == F.col("at"))
    windows = starts.select("row", "doc_id", "gram", "n", "h", "i", F.col("s.p").alias("start"),
                            F.explode("s.sizes").alias("size"))
    need = F.greatest(F.ceil(F.col("size") * F.lit(similarity) - F.lit(1e-9)).cast("int"), F.lit(1))
    last = F.get("h", F.col("i") + need - 1)["p"]
    windows = windows.filter(last < F.col("start") + F.col("size"))
    held = F.filter(F.slice("h", F.col("i") + 1, F.col("size")),
                    lambda x: x["p"] < F.col("start") + F.col("size"))
    windows = staged(windows.select(
        "row", "doc_id", "gram", "start", "size", F.least(F.col("size"), F.greatest(F.col("n") - F.col("start"), F.lit(1))).alias("own"),
        F.transform(held, lambda x: x["hash"]).alias("hashes")), "decontamination-windows")

    keys = ["row", "gram", "start", "size", "own"]       # row tells the doc_id, which may be null
    counted = windows.select(*keys, F.explode("hashes").alias("hash")).groupBy(*keys, "hash").agg(
        F.count("*").alias("weight"))
    counted = staged(counted, "decontamination-shingles")
    blocks = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    probes = _fingerprint(counted, keys).withColumn("block", F.explode(blocks)).withColumn("value", _block("print"))
    listed = _fingerprint(shingled, ["item", "item_id", "gram", "size"]).withColumn(
        "block", F.explode(blocks)).withColumn("own_value", _block("print"))
    near = F.transform(F.array(*[F.lit(m) for m in MASKS]), lambda m: F.col("own_value").bitwiseXOR(m))
    listed = listed.withColumn("value", F.explode(near)).withColumnRenamed("print", "item_print")
    candidates = staged(
        probes.join(listed, ["gram", "size", "block", "value"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select(*keys, "item", "item_id").distinct(), "decontamination-candidates")

    weights = shingled.select("item", "hash", F.col("weight").alias("item_weight"))
    shared = (candidates.join(counted, keys).join(weights, ["item", "hash"])
              .groupBy(*keys, "item", "item_id")
              .agg(F.sum(F.least("weight", "item_weight")).alias("both")))
    scored = shared.withColumn("similarity", F.col("both") / (F.col("own") + F.col("size") - F.col("both")))
    named = windows.select("row", "doc_id").distinct()
    return (scored.filter(F.col("similarity") >= similarity).join(named, "row").groupBy("row", "doc_id", "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "size")).alias("b"))
            .select("row", "doc_id", "item_id", F.col("b.similarity").alias("similarity"),
                    (-F.col("b.back")).cast("long").alias("start"), F.col("b.size").cast("long").alias("size")))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that leak an item; another text under the same
    doc_id (or another one without doc_id) stays."""
    marked = docs.select(F.struct("doc_id", F.xxhash64("text").alias("mark")).alias("doc_id"), "text")
    found = leaks(marked, items).select("doc_id.doc_id", "doc_id.mark").distinct()
    return docs.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
                                & (F.xxhash64("d.text") == F.col("f.mark")), "left_anti")


def op2(spark, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks(documents(spark, sf_dir), items).drop("row")
