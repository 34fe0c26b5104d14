"""Write-and-read-back jobs (IO keys) and catalogue listings.

Every job writes below the cluster's shared folder (``spark.checkpoint.dir``)
into a fresh path and returns the read-back table, so the lineage is cut at
each write and a lost executor only costs the tasks of the current stage.
"""

from __future__ import annotations

import dataclasses
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart import schemas
from bankmart.operators import bronze as B
from bankmart.operators import layout, quality, scd2, serving
from bankmart.plans import history, marts
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake
from bankmart.session import partition_values as committed_values, run_concurrently, scratch_path, shuffles_freed
from bankmart.sources import csv as csv_src
from bankmart.sources.adapters import customers_extract


def by_table(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows of several tables as one, each column once (NULL where a table lacks it)."""
    out = None
    for name, df in frames.items():
        df = df.withColumn("table_name", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def land_csv(lake: Lake, damaged: bool = False) -> str:
    """The five extracts as headered, compressed CSV drops.  ``damaged`` puts a text into one typed
    column of some rows, as an input with malformed rows."""
    root, drops = scratch_path(lake.spark, "landing"), {}
    for name in schemas.SOURCES:
        df = lake.extract(name)
        if damaged:
            column, key = BAD_COLUMN[name]
            bad = F.col(key).cast("long") % BAD_EVERY == 0
            df = df.withColumn(column, F.when(bad, "n/a").otherwise(F.col(column).cast("string")))
        drops[name] = df
    run_concurrently([(lambda n=n, df=df: csv_src.write_landing_csv(df, f"{root}/{n}", compressed=True)) for n, df in drops.items()])
    return root


BAD_EVERY = 97
#: source → typed column that is damaged, and the number that decides
BAD_COLUMN = {"customers": ("credit_score", "customer_id"), "accounts": ("balance", "account_id"),
              "transactions": ("amount", "account_id"), "branches": ("atm_count", "branch_id"),
              "support_tickets": ("csat_score", "ticket_id")}


@query("csv_scan")
def csv_scan(lake: Lake) -> DataFrame:
    """Land the five extracts as headered CSV, read them back typed."""
    root = land_csv(lake)
    return by_table({n: csv_src.read_drop(lake.spark, f"{root}/{n}", s).drop("_input")
                     for n, s in schemas.SOURCES.items()})


@query("ingest_ledger")
def ingest_ledger(lake: Lake) -> DataFrame:
    """Bronze landing of CSV drops with malformed rows: rows read, loaded and quarantined
    of every source, counted by the writes."""
    csv_lake = Lake(lake.spark, lake.sf_dir, lake.cfg, landing=land_csv(lake, damaged=True))
    counts: dict[str, dict] = {}
    land_bronze(csv_lake, scratch_path(lake.spark, "bronze"), counts)
    return ledger_rows(lake, counts)


def ledger_rows(lake: Lake, counts: dict[str, dict]) -> DataFrame:
    """One row per source (five rows, from the writes' counts)."""
    return lake.spark.createDataFrame(
        [(lake.cfg.batch_id, n, c["file_rows"], c["loaded"], c["quarantined"]) for n, c in counts.items()],
        "batch_id string, table_name string, file_rows long, loaded long, quarantined long")


@query("csv_quarantine")
def csv_quarantine(lake: Lake) -> DataFrame:
    """Malformed rows of the five CSV drops as quarantined: table, batch and the row's key,
    the first field of its raw text."""
    csv_lake = Lake(lake.spark, lake.sf_dir, lake.cfg, landing=land_csv(lake, damaged=True))
    paths = land_bronze(csv_lake, scratch_path(lake.spark, "bronze"))
    bad = by_table({n: B.read_quarantine(lake.spark, p) for n, p in paths.items()})
    return bad.select("table_name", F.col("_batch_id").alias("batch_id"),
                      F.split_part(csv_src.CORRUPT, F.lit(","), F.lit(1)).alias("record_key"))


def bronze_schema(name: str, partition_cols: list[str]) -> T.StructType:
    fields = list(schemas.SOURCES[name].fields)
    fields += [T.StructField("_source_system", T.StringType()),
               T.StructField("_source_file", T.StringType()),
               T.StructField("_batch_id", T.StringType()),
               T.StructField("_ingest_ts", T.TimestampNTZType()),
               T.StructField("_batch_date", T.StringType()),
               T.StructField("_is_current", T.BooleanType())]
    fields += [T.StructField(c, T.StringType()) for c in partition_cols]
    return T.StructType(fields)


def land_bronze(lake: Lake, root: str, counts: dict | None = None) -> dict[str, str]:
    """Append today's batch of every source to its Bronze table: facts by
    business month, other entities by batch date, branches full refresh.  ``counts``
    receives what each write counted.  The sources are independent, so their last tasks
    overlap as concurrent jobs."""
    paths = {name: f"{root}/{name}" for name in schemas.SOURCES}
    rows = {name: lake.extract(name) for name in paths}                # plan on this thread

    def land(name: str) -> dict[str, int]:
        system, _, date_col = schemas.SOURCE_META[name][:3]
        stamps = B.stamps(system, f"{name}.csv", lake.cfg)
        if name == "branches":
            return B.full_refresh(rows[name].withColumns(stamps), paths[name])
        return B.append(rows[name], paths[name], lake.cfg.batch_id, date_col, stamps)

    seen = run_concurrently([(lambda name=name: land(name)) for name in paths])
    if counts is not None:
        counts.update(zip(paths, seen))
    return paths


@query("bronze_append")
def bronze_append(lake: Lake) -> DataFrame:
    """Land every source and read all five Bronze tables back."""
    paths = land_bronze(lake, scratch_path(lake.spark, "bronze"))
    return by_table({n: B.read_bronze(lake.spark, p) for n, p in paths.items()})


@query("full_refresh")
def full_refresh(lake: Lake) -> DataFrame:
    """Overwrite a reference table twice; only the last state survives."""
    path = scratch_path(lake.spark, "branches")
    br = lake.bronze("branches")
    B.full_refresh(br.where(F.col("branch_id").cast("long") % 2 == 0), path)
    B.full_refresh(br, path)
    return B.read_bronze(lake.spark, path)


@query("partitioned_overwrite")
def partitioned_overwrite(lake: Lake) -> DataFrame:
    """Silver transactions by (txn_year, txn_month); then one month is
    rebuilt with a dynamic partition overwrite, leaving the others.  Both writes read
    the table as it was written once, which is dropped after them."""
    path = scratch_path(lake.spark, "silver-transactions")
    lake = lake.written_once(["silver_transactions"])
    txns = lake.silver_transactions
    month = txns.where((F.col("txn_year") == marts.PRUNE_YEAR)
                       & (F.col("txn_month") == marts.PRUNE_MONTH))
    with shuffles_freed(lake.spark):
        layout.write_partitioned_balanced(txns, path, ["txn_year", "txn_month"])
        layout.write_partitioned_balanced(month, path, ["txn_year", "txn_month"], dynamic=True)
    lake.drop_written(["silver_transactions"])
    return lake.spark.read.schema(txns.schema).parquet(path)


@query("scd2_apply")
def scd2_apply(lake: Lake) -> DataFrame:
    """Replay the yearly change batches through SCD2 apply into a versioned, bucketed
    store (closed history append-only, current versions rewritten per batch) and
    read the whole dimension back.  The log is aggregated once, into one folder per
    batch; each batch reads its own."""
    spark, batches, root = lake.spark, scratch_path(lake.spark, "scd2-batches"), scratch_path(lake.spark, "scd2-store")
    yb = history.yearly(lake)
    yb.hint("rebalance", "batch_date").write.partitionBy("batch_date").parquet(batches)
    states = T.StructType([f for f in yb.schema.fields if f.name != "batch_date"])
    dates = committed_values(spark, batches, "batch_date=")
    for d in map(date.fromisoformat, dates):
        cfg = dataclasses.replace(lake.cfg, as_of=d)
        incoming = spark.read.schema(states).parquet(f"{batches}/batch_date={d}")
        scd2.store_apply(spark, root, d.strftime("%Y%m%d") + "_000000", incoming, cfg, tracked=history.TRACKED)
    schema = scd2.scd2_initial(spark.createDataFrame([], states), lake.cfg).schema
    return scd2.store_read(spark, root, schema.add(scd2.CHANGED, "long"))


@query("dq_audit_append")
def dq_audit_append(lake: Lake) -> DataFrame:
    """Append two runs' DQ results to the audit table and read it back.  The suites are
    evaluated once; both runs are made from the written counts."""
    path, counted = scratch_path(lake.spark, "dq-audit"), scratch_path(lake.spark, "dq-counts")
    quality.all_counts(lake).write.parquet(counted)
    counts = lake.spark.read.parquet(counted)
    earlier = dataclasses.replace(lake.cfg, batch_id="20011103_000000",
                                  run_ts=lake.cfg.run_ts.replace(day=3))
    for cfg in (earlier, lake.cfg):
        quality.append_audit(quality.results(counts, cfg), path)
    return quality.read_audit(lake.spark, path)


@query("clustered_rewrite")
def clustered_rewrite(lake: Lake) -> DataFrame:
    """Customer 360 by (segment, state), the monthly mart by (txn_year, txn_month), and
    transactions co-located by customer and date at once.  Ranges are found by a pass of
    their own, so the tables are written once before; each is dropped after its last reader."""
    spark, lake = lake.spark, lake.written_once(Lake.SILVER_FACTS + ["txn_monthly_summary", "customer_360"])
    lake.drop_written(["silver_customers", "silver_accounts", "silver_tickets"])
    paths = {n: scratch_path(spark, f"{n}-clustered")
             for n in ("customer_360", "txn_monthly_summary", "silver_transactions")}
    with shuffles_freed(spark):
        layout.clustered_rewrite(lake.customer_360, paths["customer_360"], ["segment", "state"], ["customer_id"])
        lake.drop_written(["customer_360"])
        layout.clustered_rewrite(lake.txn_monthly_summary, paths["txn_monthly_summary"],
                                 ["txn_year", "txn_month"], ["customer_id"])
        lake.drop_written(["txn_monthly_summary"])
        layout.zorder_rewrite(lake.silver_transactions, paths["silver_transactions"],
                              ["customer_id", "transaction_date"], ["transaction_id"])
        lake.drop_written(["silver_transactions"])
    return by_table({n: spark.read.parquet(p) for n, p in paths.items()})


def _small_file_copy(lake: Lake) -> str:
    path = scratch_path(lake.spark, "txn-small-files")
    layout.write_partitioned(lake.silver_transactions, path, ["txn_year", "txn_month"])
    return path


@query("compact_files")
def compact_files(lake: Lake) -> DataFrame:
    """Compact a table of many small files per month and read it back."""
    path = _small_file_copy(lake)
    layout.compact(lake.spark, path, ["txn_year", "txn_month"])
    return lake.spark.read.parquet(path)


def _partitioned_transactions(lake: Lake) -> DataFrame:
    """Silver transactions as a written table: the lake's own where it has one."""
    path = lake.paths.get("silver_transactions")
    if path is None:
        path = scratch_path(lake.spark, "silver-transactions")
        layout.write_partitioned_balanced(lake.silver_transactions, path, ["txn_year", "txn_month"])
    return lake.spark.read.schema(lake.silver_transactions.schema).parquet(path)


@query("partition_values")
def partition_values(lake: Lake) -> DataFrame:
    """Partitions of the written table (only partition columns are read)."""
    return (_partitioned_transactions(lake).select("txn_year", "txn_month").distinct()
            .orderBy("txn_year", "txn_month"))


@query("partition_pruned_count")
def partition_pruned_count(lake: Lake) -> DataFrame:
    """Rows of one month; the filter prunes the scan to its partition."""
    t = _partitioned_transactions(lake)
    return (t.where((F.col("txn_year") == marts.PRUNE_YEAR) & (F.col("txn_month") == marts.PRUNE_MONTH))
             .agg(F.count(F.lit(1)).alias("row_count")))


@query("file_stats")
def file_stats(lake: Lake) -> DataFrame:
    src = _small_file_copy(lake)
    return layout.file_stats(lake.spark, src).withColumn("table_name", F.lit("silver_transactions"))


def _served_lake(lake: Lake) -> Lake:
    """The served tables, written: every table is computed once, from written ones, and the
    Silver ones are dropped after them."""
    lake = lake.written_once(Lake.SILVER_FACTS + Lake.GOLD + ["dq_results"], Lake.GOLD_READS)
    lake.drop_written(Lake.SILVER_FACTS)
    return lake


def _served(lake: Lake) -> dict[str, DataFrame]:
    return {n: getattr(lake, n) for n in [*Lake.GOLD, "dq_results"]}


def _serving_staged(lake: Lake) -> dict[str, DataFrame]:
    return _served(_served_lake(lake))


def load_serving(lake: Lake, staged: dict[str, DataFrame], root: str) -> tuple[dict[str, str], dict[str, dict]]:
    """Load each staged table with its serving types; folders and counts."""
    paths, counts = {}, {}
    with shuffles_freed(lake.spark):
        for name, df in staged.items():
            paths[name] = f"{root}/{name}"
            counts[name] = serving.load(df, name, paths[name], lake.cfg)
    return paths, counts


@query("serving_load")
def serving_load(lake: Lake) -> DataFrame:
    """Stage the four marts and the audit as Parquet, load them with the serving types,
    read the loaded tables back."""
    paths, _ = load_serving(lake, _serving_staged(lake), scratch_path(lake.spark, "serving"))
    return by_table({n: serving.read_loaded(lake.spark, p, n) for n, p in paths.items()})


def _damaged_marts(lake: Lake) -> dict[str, DataFrame]:
    """The staged tables with values that do not fit their serving types, as an input that
    is staged in their place."""
    lake, spark = _served_lake(lake), lake.spark
    staged = _served(lake)
    number = F.col("customer_id").cast("long")
    staged["customer_360"] = staged["customer_360"].withColumns({
        "state": F.when(number % 89 == 0, "Nowhere").otherwise(F.col("state")),
        "credit_score": F.when(number % 83 == 0, "n/a").otherwise(F.col("credit_score").cast("string"))})
    staged["txn_monthly_summary"] = staged["txn_monthly_summary"].withColumns({
        "customer_id": F.when(number % 79 != 0, F.col("customer_id")),
        "txn_count": F.when(number % 73 == 0, "many").otherwise(F.col("txn_count").cast("string"))})
    staged["support_kpis"] = staged["support_kpis"].withColumn(
        "priority", F.when(F.col("priority") == "Low", F.repeat("priority", 9)).otherwise(F.col("priority")))
    for name in ("customer_360", "txn_monthly_summary", "support_kpis"):
        stage = scratch_path(spark, f"stage-{name}")
        staged[name].write.option("compression", "zstd").parquet(stage)
        staged[name] = spark.read.schema(staged[name].schema).parquet(stage)
        lake.drop_written([name])
    return staged


@query("serving_rejects")
def serving_rejects(lake: Lake) -> DataFrame:
    """Load damaged tables: rejected rows per table and reason codes."""
    paths, _ = load_serving(lake, _damaged_marts(lake), scratch_path(lake.spark, "serving"))
    bad = by_table({n: serving.read_rejects(lake.spark, p) for n, p in paths.items()})
    return bad.groupBy("table_name", F.array_join("_reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("row_count"))


@query("serving_ledger")
def serving_ledger(lake: Lake) -> DataFrame:
    """Load damaged tables: staged, loaded and rejected rows of each, counted by the loads."""
    _, counts = load_serving(lake, _damaged_marts(lake), scratch_path(lake.spark, "serving"))
    return lake.spark.createDataFrame([(n, c["staged"], c["loaded"], c["rejected"]) for n, c in counts.items()],
                                      "table_name string, staged long, loaded long, rejected long")


@query("registered_tables")
def registered_tables(lake: Lake) -> DataFrame:
    """Register the ten tables in the session catalogue, then read each by
    its registered name: one row per table with its rows."""
    out = None
    for name in Lake.SILVER + Lake.GOLD + ["dq_results"]:
        registered = f"registered_{name}"
        getattr(lake, name).createOrReplaceTempView(registered)
        rows = lake.spark.table(registered).agg(F.lit(name).alias("table_name"),
                                                F.count(F.lit(1)).alias("row_count"))
        out = rows if out is None else out.unionByName(rows)
    return out
