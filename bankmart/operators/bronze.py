"""Bronze: stamped, append-only landing tables.

Rows that could not be parsed (``_corrupt_record`` is not NULL) go to a quarantine
partition of the batch in the same write; counts of both come from that write too.
Batches may add columns or widen types; tables are read in the merged schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from bankmart.config import RunConfig, DEFAULT
from bankmart.operators import evolve
from bankmart.operators.dedup import dedup_latest
from bankmart.session import committed_subdirs, partition_values
from bankmart.sources.csv import CORRUPT


def stamp(df: DataFrame, source_system: str, source_file: str,
          cfg: RunConfig = DEFAULT) -> DataFrame:
    """Add the six ingestion metadata columns.

    ``source_file`` is a literal name; pass ``None`` to take each row's real
    input file from the scan's ``_metadata`` column instead.
    """
    return df.withColumns(stamps(source_system, source_file, cfg))


def stamps(source_system: str, source_file: str, cfg: RunConfig = DEFAULT) -> dict:
    """The six ingestion metadata columns of :func:`stamp`."""
    file_col = (F.col("_metadata.file_name") if source_file is None
                else F.lit(source_file))
    return {
        "_source_system": F.lit(source_system),
        "_source_file": file_col,
        "_batch_id": F.lit(cfg.batch_id),
        "_ingest_ts": cfg.run_ts_col(),
        "_batch_date": F.lit(cfg.batch_date),
        "_is_current": F.lit(True),
    }


def month_key(date_text_col: str) -> F.Column:
    """Month-grain partition key (``yyyy-MM``) from a ``yyyy-MM-dd`` text
    date: daily folders make many tiny files, months keep pruning useful.
    Rows without a readable date share the partition ``unknown``, as they
    share the NULL month of Silver."""
    parsed = F.expr(f"try_to_date(`{date_text_col}`, 'yyyy-MM-dd')")
    return F.coalesce(F.date_format(parsed, "yyyy-MM"), F.lit("unknown"))


STATUS, LOADED, QUARANTINED = "_row_status", "loaded", "quarantined"
INPUT = "_input"                        # where a quarantined row was read


def _split(df: DataFrame) -> DataFrame:
    """Rows with their status; only quarantined ones keep where they were read."""
    for c in (CORRUPT, INPUT):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    bad = F.col(CORRUPT).isNotNull()
    return df.withColumns({STATUS: F.when(bad, QUARANTINED).otherwise(LOADED),
                           INPUT: F.when(bad, F.col(INPUT))})


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the counts that its write will make."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("file_rows"),
                      F.count_if(F.col(STATUS) == LOADED).alias("loaded"),
                      F.count_if(F.col(STATUS) == QUARANTINED).alias("quarantined")), seen


def append(df: DataFrame, path: str, batch_id: str, business_date: str | None = None,
           stamped: dict | None = None) -> dict[str, int]:
    """Append one batch.  The batch id is the outermost partition and a rerun
    replaces its folder as a whole, so a corrected extract leaves nothing of
    the first one while other batches stay.  Inside it rows are split by status, and
    facts are partitioned by business month, other sources by batch date; the rebalance
    keeps that to about one file per month instead of tasks × months.  ``stamped`` has
    columns of one value (:func:`stamps`), which are set after that shuffle.

    A batch whose types conflict with earlier ones is refused before anything is written.
    Returns file_rows, loaded and quarantined, counted by the write itself (after its
    last shuffle, so a retried task counts once)."""
    spark, stamped = df.sparkSession, dict(stamped or {})
    rows, out, part = _split(df), _split(df.withColumns(stamped)), "_batch_date"
    if business_date is not None:
        part = "_month"
        rows, out = (d.withColumn(part, month_key(business_date)) for d in (rows, out))
    out = out.drop("_batch_id")
    others = [(b, s) for b, s in evolve.batch_schemas(spark, path) if b != batch_id]
    evolve.check([*others, (batch_id, out.schema)])
    dealt = rows.hint("rebalance", *[c for c in (STATUS, part) if c not in stamped])
    out, seen = _counted(dealt.withColumns(stamped).select(*out.columns))
    out.write.mode("overwrite").partitionBy(STATUS, part).parquet(f"{path}/_batch_id={batch_id}")
    evolve.record(spark, path, batch_id, out.schema)
    return dict(seen.get)


def full_refresh(df: DataFrame, path: str) -> dict[str, int]:
    """Overwrite a small reference table completely (same split and counts)."""
    out, seen = _counted(_split(df))
    out.write.mode("overwrite").partitionBy(STATUS).parquet(path)
    return dict(seen.get)


def _all_rows(spark: SparkSession, path: str, batches: list[str] | None = None) -> DataFrame:
    if partition_values(spark, path, f"{STATUS}="):                  # a full-refresh table
        return spark.read.parquet(path)
    return evolve.read(spark, path, batches=batches)


def read_bronze(spark: SparkSession, path: str, batches: list[str] | None = None) -> DataFrame:
    """Loaded rows of all batches (or of ``batches``) in the merged schema."""
    return (_all_rows(spark, path, batches).where(F.col(STATUS) == LOADED)
            .drop(STATUS, CORRUPT, INPUT))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined rows: batch, raw text, and the file and block they were read from."""
    return (_all_rows(spark, path).where(F.col(STATUS) == QUARANTINED)
            .select("_batch_id", CORRUPT, INPUT))


def batch_ledger(bronze: DataFrame, n: int = 5) -> DataFrame:
    """History of a Bronze table: one row per batch, newest first."""
    return (bronze.groupBy("_batch_id")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.min("_ingest_ts").alias("first_ingest_ts"),
                 F.max("_ingest_ts").alias("last_ingest_ts"),
                 F.max("_batch_date").alias("batch_date"))
            .orderBy(F.col("_batch_id").desc())
            .limit(n))


def resolve_instants(ledger: DataFrame, instants: DataFrame) -> DataFrame:
    """The newest batch at or before each instant (NULL: none yet).

    ``ledger`` has one row per batch (_batch_id, first_ingest_ts), ``instants`` one row per
    question (asked, instant): both in one ordered union, so one window pass answers
    all.  Both are lists of batches and questions, never table rows."""
    marks = ledger.select(F.col("first_ingest_ts").alias("at"), F.lit(0).alias("kind"),
                          F.lit(None).cast("string").alias("asked"), F.col("_batch_id").alias("batch"))
    asked = instants.select(F.col("instant").alias("at"), F.lit(1).alias("kind"), "asked",
                            F.lit(None).cast("string").alias("batch"))
    w = Window.orderBy("at", "kind", "batch").rowsBetween(Window.unboundedPreceding, 0)
    return (marks.unionByName(asked).withColumn("batch", F.last("batch", ignorenulls=True).over(w))
            .where("kind = 1").select("asked", "batch"))


def snapshots(spark: SparkSession, path: str, key: str, asked: dict[str, str | None], tie_break=()) -> DataFrame:
    """State of an append-only table as of several batches: for each entry (label → batch
    id) the latest row per key among the batches at or before it, with the label as ``asked``.

    Only folders up to the newest batch asked for are read, and once: a row answers the
    questions between its batch and its key's next one."""
    wanted = sorted((b, label) for label, b in asked.items() if b is not None)
    known = committed_subdirs(spark, path, "_batch_id=")
    rows = read_bronze(spark, path, [b for b in known if wanted and b <= wanted[-1][0]])
    in_batch = [("_ingest_ts", "desc"), *tie_break]
    latest = dedup_latest(rows, [key, "_batch_id"], in_batch)
    following = F.lead("_batch_id").over(Window.partitionBy(key).orderBy("_batch_id"))
    questions = F.array(*[F.struct(F.lit(b).alias("batch"), F.lit(label).alias("asked")) for b, label in wanted])
    if not wanted:
        return rows.withColumn("asked", F.lit("")).limit(0)
    answers = F.filter(questions, lambda q: (q["batch"] >= F.col("_batch_id"))
                       & (F.col("_next").isNull() | (q["batch"] < F.col("_next"))))
    return (latest.withColumn("_next", following).withColumn("_q", F.explode(answers))
            .withColumn("asked", F.col("_q.asked")).drop("_next", "_q"))


def snapshot_as_of(spark: SparkSession, path: str, key: str, batches=(), instants=(), tie_break=()) -> DataFrame:
    """Point-in-time read by batch ids and by instants (texts), each a value of ``asked``."""
    found = {b: b for b in batches}
    if instants:
        questions = spark.createDataFrame([(i,) for i in instants], "asked string").withColumn(
            "instant", F.col("asked").cast("timestamp_ntz"))
        ledger = read_bronze(spark, path).groupBy("_batch_id").agg(F.min("_ingest_ts").alias("first_ingest_ts"))
        found.update({r["asked"]: r["batch"] for r in resolve_instants(ledger, questions).collect()})
    return snapshots(spark, path, key, found, tie_break)


def schema_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Additive schema union: columns missing on one side become NULL."""
    return old.unionByName(new, allowMissingColumns=True)

