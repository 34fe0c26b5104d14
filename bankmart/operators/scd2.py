"""Slowly-changing dimension, type 2, on plain Parquet (no MERGE).

Versions are half-open date intervals ``[scd_start_date, scd_end_date)``;
the end of one version is the start of the next.  Versions count up from 1.
A change is a null-safe difference in any tracked column, so NULL→value and
value→NULL are changes too.  Stored versions carry a digest of their tracked
columns (``scd_digest``), which tells changed rows without comparing columns,
and the columns that changed since the version before, as bits of
``scd_changed`` (bit i is ``tracked[i]``; 0 for a first version).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart import domains as D
from bankmart.config import RunConfig, DEFAULT
from bankmart.operators.buckets import note_buckets, noted_buckets, read_bucketed, write_bucketed

SCD_COLS = ["scd_start_date", "scd_end_date", "scd_is_current", "scd_version"]


DIGEST, CHANGED, KEY = "scd_digest", "scd_changed", "scd_key"


def row_digest(tracked: Sequence[str], alias: str | None = None) -> Column:
    """SHA-256 of the tracked columns as text; NULL and text cannot be mixed up,
    nor can two neighbouring values."""
    def part(c):
        text = F.col(f"{alias}.{c}" if alias else c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in tracked]), 256))


def changed_mask(old, new, tracked: Sequence[str]) -> Column:
    """Bits of the tracked columns that differ (null-safe); ``old`` and ``new`` give
    the column of a name."""
    bits = [F.when(old(c).eqNullSafe(new(c)), 0).otherwise(1 << i) for i, c in enumerate(tracked)]
    return reduce(lambda a, b: a + b, bits).cast("long")


def _of(alias: str):
    return lambda c: F.col(f"{alias}.{c}")


def _digested(df: DataFrame, tracked: Sequence[str]) -> DataFrame:
    return df if DIGEST in df.columns else df.withColumn(DIGEST, row_digest(tracked))


def scd2_initial(incoming: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """First load: every row is version 1 with an open interval."""
    return incoming.withColumns({
        "scd_start_date": F.lit(cfg.as_of),
        "scd_end_date": F.lit(None).cast("date"),
        "scd_is_current": F.lit(True),
        "scd_version": F.lit(1),
    })


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("scd_is_current"))


def scd2_new_keys(dim: DataFrame, incoming: DataFrame, key: str = "customer_id") -> DataFrame:
    """Incoming rows whose key has no current version (left anti-join)."""
    cur = current_rows(dim).select(F.col(key).alias("_current_key"))
    return incoming.join(cur, F.col(key).eqNullSafe(F.col("_current_key")), "left_anti")


def scd2_changed_keys(dim: DataFrame, incoming: DataFrame, key: str = "customer_id",
                      tracked: Sequence[str] = D.SCD2_TRACKED) -> DataFrame:
    """Incoming rows whose current version differs in a tracked column, with that
    version's number and the columns that differ as bits."""
    cur = _digested(current_rows(dim), tracked).select(key, *tracked, DIGEST, "scd_version").alias("o")
    inc = incoming.withColumn(DIGEST, row_digest(tracked)).alias("n")
    return (inc.join(cur, F.col(f"n.{key}").eqNullSafe(F.col(f"o.{key}")), "inner")
               .where(F.col(f"o.{DIGEST}") != F.col(f"n.{DIGEST}"))
               .select(*[F.col(f"n.{c}") for c in incoming.columns],
                       F.col("o.scd_version").alias("previous_version"),
                       changed_mask(_of("o"), _of("n"), tracked).alias("changed_columns")))


def scd2_apply(dim: DataFrame, incoming: DataFrame, cfg: RunConfig = DEFAULT,
               key: str = "customer_id",
               tracked: Sequence[str] = D.SCD2_TRACKED) -> DataFrame:
    """Next state of the dimension after one incoming batch.

    One full outer join of the current versions with the batch (one shuffle
    on the key) classifies every key as new, changed, unchanged or absent;
    each joined row emits its surviving old version and/or its new version
    through a single ``explode`` so the join is evaluated once.  Closed
    history passes through untouched.  Keys absent from the batch stay
    current (there is no delete).  A NULL key is a key like any other (the
    DQ rules report it).  Applying the same batch twice is a no-op.  Digest and
    change bits are kept up if ``dim`` has them.
    """
    cols = dim.columns
    made = [*SCD_COLS, DIGEST, CHANGED]
    attrs = [c for c in cols if c not in made]
    inc = incoming.select(*[F.col(c) if c in incoming.columns else F.lit(None).alias(c)
                            for c in attrs])
    closed = dim.where(~F.col("scd_is_current"))
    cur = _digested(current_rows(dim), tracked).withColumn("_side", F.lit(True))
    inc = inc.withColumn(DIGEST, row_digest(tracked)).withColumn("_side", F.lit(True))
    # a stored key is never NULL and equality keeps the stored partitioning
    same = F.col(f"o.{key}") == F.col(f"n.{key}") if key == KEY else \
        F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}"))
    j = cur.alias("o").join(inc.alias("n"), same, "full_outer")
    has_old = F.col("o._side").isNotNull()
    has_new = F.col("n._side").isNotNull()
    changed = has_old & has_new & (F.col(f"o.{DIGEST}") != F.col(f"n.{DIGEST}"))
    as_of = F.lit(cfg.as_of)
    kept = [c for c in (DIGEST, CHANGED) if c in cols]
    old_row = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in attrs],
        F.col("o.scd_start_date").alias("scd_start_date"),
        F.when(changed, as_of).otherwise(F.col("o.scd_end_date")).alias("scd_end_date"),
        (~changed).alias("scd_is_current"),
        F.col("o.scd_version").alias("scd_version"),
        *[F.col(f"o.{c}").alias(c) for c in kept])
    fresh = {DIGEST: F.col(f"n.{DIGEST}"),
             CHANGED: F.when(has_old, changed_mask(_of("o"), _of("n"), tracked)).otherwise(F.lit(0)).cast("long")}
    new_row = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in attrs],
        as_of.alias("scd_start_date"),
        F.lit(None).cast("date").alias("scd_end_date"),
        F.lit(True).alias("scd_is_current"),
        (F.coalesce(F.col("o.scd_version"), F.lit(0)) + 1).alias("scd_version"),
        *[fresh[c].alias(c) for c in kept])
    # by cases, not by a filter of both versions, which Spark would run interpreted
    emitted = (j.select(F.inline(F.when(changed, F.array(old_row, new_row))
                                 .when(has_old, F.array(old_row)).otherwise(F.array(new_row)))))
    return closed.select(*cols).unionByName(emitted.select(*cols))


def scd2_history(log: DataFrame, key: str = "customer_id",
                 tracked: Sequence[str] = ("segment",),
                 effective: str = "effective_date", seq: str = "seq") -> DataFrame:
    """Whole version history from a change log in one pass.

    1. collapse to the last state per (key, effective day) — a partial
       aggregate, so a hot key shrinks to one row per day before the
       shuffle and same-day changes cannot make zero-length intervals;
    2. keep the first row per key and every row whose digest differs from the
       previous one's, with the changed columns as bits: the gaps between these
       rows are the islands of one state;
    3. the next kept row's start is this row's end; number the versions.
    """
    tracked = list(tracked)
    daily = (log.groupBy(key, effective)
                .agg(F.max_by(F.struct(*tracked), F.col(seq)).alias("_s"))
                .select(key, F.col(effective).alias("scd_start_date"),
                        *[F.col(f"_s.{c}").alias(c) for c in tracked]))
    w = Window.partitionBy(key).orderBy("scd_start_date")
    state = F.struct(*tracked)
    kept = (daily.withColumn(DIGEST, row_digest(tracked))
                 .withColumns({"_first": F.row_number().over(w) == 1, "_digest": F.lag(DIGEST).over(w),
                               "_state": F.lag(state).over(w)})
                 .where(F.col("_first") | (F.col("_digest") != F.col(DIGEST)))
                 .withColumn(CHANGED, F.when(F.col("_first"), F.lit(0).cast("long"))
                             .otherwise(changed_mask(_of("_state"), F.col, tracked))))
    return (kept
            .withColumn("scd_end_date", F.lead("scd_start_date").over(w))
            .withColumn("scd_version", F.row_number().over(w))
            .withColumn("scd_is_current", F.col("scd_end_date").isNull())
            .select(key, *tracked, "scd_start_date", "scd_end_date",
                    "scd_is_current", "scd_version", CHANGED))


def scd2_as_of(dim: DataFrame, on) -> DataFrame:
    """Version valid on date ``on``: start <= d AND (end IS NULL OR d < end)."""
    d = F.lit(on)
    return dim.where((F.col("scd_start_date") <= d)
                     & (F.col("scd_end_date").isNull() | (d < F.col("scd_end_date"))))


def scd2_counts(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col("scd_is_current")).alias("current_rows"))


def yearly_batches(log: DataFrame, key: str = "customer_id",
                   tracked: Sequence[str] = ("segment",),
                   effective: str = "effective_date", seq: str = "seq") -> DataFrame:
    """Last state per key and year of the change log; the batch takes effect
    on January 1 of the following year (column ``batch_date``)."""
    tracked = list(tracked)
    return (log.groupBy(key, F.year(effective).alias("_y"))
               .agg(F.max_by(F.struct(*tracked), F.struct(effective, seq)).alias("_s"))
               .select(key, F.make_date(F.col("_y") + 1, F.lit(1), F.lit(1)).alias("batch_date"),
                       *[F.col(f"_s.{c}").alias(c) for c in tracked]))


# ── versioned storage: closed history append-only, current rewritten ────────
#
#   <root>/batch=<batch_id>/scd_is_current=false/   versions closed by that batch
#   <root>/batch=<batch_id>/scd_is_current=true/    all current versions after it
#   <root>/_buckets/batch=<batch_id>/               its number of buckets
#
# A batch folder is bucketed and sorted by ``scd_key`` (the key as text, never
# NULL), so the next batch joins it without moving the stored side.  Each batch
# writes O(current customers) rows; closed history is never rewritten, and current
# versions older than the predecessor's are retired.  The dimension = every
# batch's closed rows + the newest batch's current rows.  A batch folder
# without _SUCCESS is ignored.

STORED = [KEY, DIGEST, CHANGED]


def stored_key(key: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def _stored_fields(schema: T.StructType) -> list[T.StructField]:
    own = [f for f in schema.fields if f.name != "scd_is_current" and f.name not in STORED]
    return own + [T.StructField(KEY, T.StringType()), T.StructField(DIGEST, T.BinaryType()),
                  T.StructField(CHANGED, T.LongType())]


def _store_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(_stored_fields(schema) + [T.StructField("batch", T.StringType()),
                                                  T.StructField("scd_is_current", T.BooleanType())])


def store_batches(spark, root: str) -> list[str]:
    from bankmart.session import committed_subdirs
    return committed_subdirs(spark, root, "batch=")


def store_read(spark, root: str, schema: T.StructType, current_only: bool = False):
    """The dimension (or only its current versions) from a store; None if
    the store has no committed batch.  ``schema`` may name ``scd_changed`` too."""
    batches = store_batches(spark, root)
    if not batches:
        return None
    latest = batches[-1]
    paths = [f"{root}/batch={latest}"] if current_only else [f"{root}/batch={b}" for b in batches]
    df = (spark.read.schema(_store_schema(schema)).option("basePath", root).parquet(*paths))
    keep = (F.col("batch") == latest) & F.col("scd_is_current") if current_only else \
        (~F.col("scd_is_current")) | (F.col("batch") == latest)
    return df.where(keep).select(*schema.fieldNames())


def store_schema(spark, root: str) -> T.StructType | None:
    """Dimension schema of a store, from its newest committed batch."""
    batches = store_batches(spark, root)
    if not batches:
        return None
    leaf = spark.read.parquet(f"{root}/batch={batches[-1]}/scd_is_current=true")
    fields = [f for f in leaf.schema.fields if f.name not in STORED]
    idx = [f.name for f in fields].index("scd_end_date") + 1
    fields.insert(idx, T.StructField("scd_is_current", T.BooleanType()))
    return T.StructType(fields)


def stored_current(spark, root: str, batch: str, schema: T.StructType, buckets: int) -> DataFrame:
    """Current versions of a stored batch as a bucketed table."""
    columns = T.StructType(_stored_fields(schema) + [T.StructField("scd_is_current", T.BooleanType())])
    order = [f.name for f in schema.fields if f.name not in STORED] + STORED
    table = read_bucketed(spark, f"{root}/batch={batch}", columns, buckets, KEY, "scd_is_current")
    return table.where(F.col("scd_is_current")).select(*order)


def _buckets_path(root: str, batch: str) -> str:
    return f"{root}/_buckets/batch={batch}"


def store_next(spark, root: str, batch_id: str, incoming: DataFrame, cfg: RunConfig,
               key: str = "customer_id", tracked: Sequence[str] = D.SCD2_TRACKED,
               buckets: int | None = None) -> tuple[DataFrame, int]:
    """Rows that ``batch_id`` adds to the store and their number of buckets.

    Only the incoming side is shuffled, into the stored buckets.  Their number starts
    as the session's shuffle partitions and is doubled (one shuffle of the stored
    side) when a bucket of the predecessor outgrows a shuffle partition."""
    from bankmart.session import SHUFFLE_TARGET_BYTES, input_bytes
    schema = scd2_initial(incoming, cfg).schema
    incoming = incoming.withColumn(KEY, stored_key(key))
    prior = [b for b in store_batches(spark, root) if b < batch_id]
    if not prior:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        first = scd2_initial(incoming.repartition(n, KEY), cfg)
        return first.withColumns({DIGEST: row_digest(tracked), CHANGED: F.lit(0).cast("long")}), n
    n = noted_buckets(spark, _buckets_path(root, prior[-1]))
    current = stored_current(spark, root, prior[-1], schema, n)
    stored = input_bytes(spark, [f"{root}/batch={prior[-1]}/scd_is_current=true"])
    wanted = buckets or (2 * n if stored > n * SHUFFLE_TARGET_BYTES else n)
    if wanted != n:
        current = current.repartition(wanted, KEY)
    return scd2_apply(current, incoming.repartition(wanted, KEY), cfg, KEY, tracked), wanted


def store_apply(spark, root: str, batch_id: str, incoming: DataFrame, cfg: RunConfig,
                key: str = "customer_id", tracked: Sequence[str] = D.SCD2_TRACKED,
                buckets: int | None = None) -> None:
    """Apply one batch to the store.  Batches come in order: a rerun of the
    newest one is applied again to its predecessor, so a corrected extract
    takes effect; a batch older than the newest is refused."""
    from bankmart.session import delete_folder
    batches = store_batches(spark, root)
    later = [b for b in batches if b > batch_id]
    if later:
        raise ValueError(f"batch {batch_id} is older than batch {later[-1]} of {root}")
    rows, n = store_next(spark, root, batch_id, incoming, cfg, key, tracked, buckets)
    note_buckets(spark, _buckets_path(root, batch_id), n)
    write_bucketed(rows, f"{root}/batch={batch_id}", n, KEY, "scd_is_current")
    for old in [b for b in batches if b < batch_id][:-1]:
        delete_folder(spark, f"{root}/batch={old}/scd_is_current=true")
