"""Mix sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies
``target / source size``.  Documents are laid out along a line, source by
source, in order of size; the running sum of expected copies plus one random
offset per source is cut at every integer, and a document is emitted once for
each integer boundary that its own stretch crosses.  Neighbours on the line
have like sizes, so the words taken from a source stay close to its target.

The running sum is distributed: rows are range-partitioned by
(source, size, hash), counts per partition and source give each partition's
base, and a row number within (partition, source) does the rest; a hot source
is spread over many partitions.

Defined cases: null or empty text has size 0; a null source is a source of its
own (last in order); null or repeated doc_ids are separate documents; an empty
table gives an empty result; other columns of the input, of any name and type, are not
read by the plan and are passed through by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import SPACE_WORD, staged

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: expected copies are multiples of 1/SCALE, so running sums are exact
SCALE = 1 << 24


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat=MAX_REPEAT) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, source_size, n_docs).

    Targets share the sum of all sizes by weight and stop at ``max_repeat``
    times their source's size; the excess is shared again by weight among the
    others.  With sources in rising order of cap / weight, the stopped ones
    are a prefix, so one running sum finds them.  Works on one row per source.
    """
    order = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    caps = (sizes.withColumn("_weight", weight)
            .withColumn("_cap", (F.col("source_size") * max_repeat).cast("double"))
            .withColumn("_total", F.sum("source_size").over(everything).cast("double")))
    rising = (Window.partitionBy().orderBy(F.col("_cap") / F.col("_weight"), "source")
              .rowsBetween(Window.unboundedPreceding, -1))
    onward = (Window.partitionBy().orderBy(F.col("_cap") / F.col("_weight"), "source")
              .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = ((F.col("_total") - F.coalesce(F.sum("_cap").over(rising), F.lit(0.0)))
             / F.sum("_weight").over(onward))
    stops = caps.withColumn("_level", level).withColumn(
        "_stopped", F.col("_cap") <= F.col("_weight") * F.col("_level"))
    # the level of the first source that is not stopped holds for all others
    final = F.min(F.when(~F.col("_stopped"), F.struct((F.col("_cap") / F.col("_weight")).alias("r"),
                                                      F.col("_level").alias("l")))).over(everything)
    return stops.withColumn("_final", final["l"]).select(
        "source", "source_size", "n_docs",
        F.when(F.col("_stopped") | F.col("_final").isNull(), F.col("_cap"))
        .otherwise(F.least(F.col("_cap"), F.col("_weight") * F.col("_final"))).alias("target"))


def _mark():
    """Tells rows of one doc_id apart; rows of one doc_id, text and source are interchangeable."""
    return F.xxhash64("text", "source")


def mixing_plan(docs: DataFrame, seed: int = 7, weights=WEIGHTS,
                max_repeat=MAX_REPEAT) -> DataFrame:
    """(doc_id, mark, source, size, source_size, target, copies) per document."""
    size = F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("long")
    sized = staged(docs.select("doc_id", "source", size.alias("size"), _mark().alias("mark")),
                   "mixing-sizes")
    place = F.xxhash64("doc_id", "mark", F.lit(seed))
    line = (sized.withColumn("_place", place)
            .repartitionByRange("source", "size", "_place")
            .withColumn("_part", F.spark_partition_id()))
    line = staged(line, "mixing-line")
    counts = line.groupBy("_part", "source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    per_source = counts.groupBy("source").agg(F.sum("words").alias("source_size"),
                                              F.sum("n").alias("n_docs"))
    targets = source_targets(per_source, weights, max_repeat)
    before = (Window.partitionBy("source").orderBy("_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = (counts.withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .select("_part", "source", "_base"))
    ratio = F.least(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(float(max_repeat)))
    steps = targets.select(
        "source", "source_size", "target",
        F.coalesce(F.floor(ratio * SCALE), F.lit(0)).cast("decimal(10,0)").alias("_step"),
        F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(SCALE)).cast("decimal(10,0)").alias("_offset"))
    # one row per partition and source that meet: at most partitions + sources
    bases = bases.alias("b").join(
        steps.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select(
        "_part", "b.source", "_base", "source_size", "target", "_step", "_offset")
    within = Window.partitionBy("_part", "source").orderBy("size", "_place")
    numbered = line.withColumn("_at", F.row_number().over(within)).alias("l").join(
        bases.alias("b"), (F.col("l._part") == F.col("b._part"))
        & F.col("l.source").eqNullSafe(F.col("b.source")))
    rank = (F.col("_base") + F.col("_at")).cast("decimal(18,0)")
    upto = F.floor((F.col("_offset") + rank * F.col("_step")) / F.lit(SCALE))
    below = F.floor((F.col("_offset") + (rank - 1) * F.col("_step")) / F.lit(SCALE))
    return numbered.select("doc_id", "mark", "l.source", "size", "source_size", "target",
                           (upto - below).cast("long").alias("copies"))


def mixed(docs: DataFrame, seed: int = 7, weights=WEIGHTS, max_repeat=MAX_REPEAT) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken.  Rows of one doc_id,
    text and source share their copies evenly."""
    taken = mixing_plan(docs, seed, weights, max_repeat).groupBy("doc_id", "mark").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("alike")).filter("copies > 0")
    # the row travels as one value, so its columns may have any names and types
    packed = docs.select("doc_id", _mark().alias("mark"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = packed.alias("d").join(taken.alias("t"), (F.col("d.mark") == F.col("t.mark"))
                                   & F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))).select(
        "d.doc_id", "d.mark", "row", "copies", "alike")
    place = F.row_number().over(Window.partitionBy("mark", "doc_id").orderBy(F.lit(1)))
    own = F.floor(F.col("copies") / F.col("alike")) + (F.col("place") <= F.col("copies") % F.col("alike")).cast("long")
    return (found.withColumn("place", place)
            .select("row", F.explode(F.array_repeat(F.lit(1), own.cast("int"))).alias("copy"))
            .select("row.*"))


def op7(spark, sf_dir: str) -> DataFrame:
    from bankmart.llm.common import documents
    plan = mixing_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))
