"""The daily batch: Bronze → Silver (SCD2) → DQ gate → Gold → serving.

Tables pass between stages only through the warehouse folder (each stage
reads what the previous one wrote), so any stage can be rerun alone and a
failure never leaves a half-built in-memory lineage.  Every write is
idempotent per batch: Bronze and the DQ audit replace their own batch
partitions, the SCD2 store applies a rerun batch again to its predecessor,
Silver and Gold are overwrites.  Batches run in order: the newest may be
rerun (with a corrected extract), an older one is refused.  Independent
tables of a stage are written as concurrent jobs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.config import RunConfig, DEFAULT
from bankmart.operators import bronze as B
from bankmart.operators import quality, scd2, serving, silver
from bankmart.operators.merge import KeyedTable
from bankmart.plans.jobs import land_bronze, ledger_rows
from bankmart.plans.lake import Lake
from bankmart.session import (committed_subdirs, delete_folder, input_bytes, partition_values,
                              run_concurrently, tune_for_input)

MONTH = Lake.MERGED["silver_transactions"][2]


def merge_transactions(spark: SparkSession, path: str, new: DataFrame) -> None:
    """Bring clean rows, one per id, into a transactions table by month; its key index is
    built if it has none yet."""
    table = KeyedTable(spark, path, "transaction_id", MONTH)
    if not partition_values(spark, table.index_path, "home="):
        table._note(table.read(new.schema), "built", first=True)
    table.merge(new, f"merge-{uuid.uuid4().hex}")


@dataclass
class RunResult:
    paths: dict
    dq: dict
    ingest: dict


def run(spark: SparkSession, sf_dir: str | None, warehouse: str, cfg: RunConfig = DEFAULT,
        tune: bool = False, landing: str | None = None,
        declared: dict[str, dict[str, str]] | None = None) -> RunResult:
    """One daily batch, from the test tables of ``sf_dir`` or from CSV drops
    ``<landing>/<source>/`` (``declared``: types of columns new to a source).  ``tune=True``
    sizes shuffle partitions and scan splits from the input size first (see
    :func:`bankmart.session.tune_for_input`)."""
    lake = Lake(spark, sf_dir, cfg, landing, declared)
    paths = {}
    if tune:
        tune_for_input(spark, input_bytes(spark, [landing or sf_dir, f"{warehouse}/bronze"]))

    landed = committed_subdirs(spark, f"{warehouse}/bronze/transactions", "_batch_id=")
    if landed and landed[-1] > cfg.batch_id:
        raise ValueError(f"batch {cfg.batch_id} is older than batch {landed[-1]} of {warehouse}")

    # Bronze: append today's batch
    counts: dict[str, dict] = {}
    bronze_paths = land_bronze(lake, f"{warehouse}/bronze", counts)
    (ledger_rows(lake, counts).write.mode("overwrite").partitionBy("batch_id")
     .option("partitionOverwriteMode", "dynamic").parquet(f"{warehouse}/audit/ingest"))
    # all batches in the merged schema: a new source column passes to Silver
    bz = {n: B.read_bronze(spark, p) for n, p in bronze_paths.items()}
    # today's batch only (Bronze keeps every batch)
    today = {n: df.where(F.col("_batch_id") == cfg.batch_id) for n, df in bz.items()}

    # Silver: SCD2 customers, versioned store (closed history append-only)
    cust_root = f"{warehouse}/silver/customers_scd2"
    incoming = silver.clean_customers(today["customers"], cfg)
    scd2.store_apply(spark, cust_root, cfg.batch_id, incoming, cfg)
    lake._tables["silver_customers"] = scd2.store_read(
        spark, cust_root, scd2.scd2_initial(incoming, cfg).schema)
    paths["silver_customers"] = cust_root
    paths["silver_branches"] = f"{warehouse}/silver/silver_branches"
    branches = silver.silver_branches(today["branches"], cfg)
    actions = [lambda: branches.write.mode("overwrite").parquet(paths["silver_branches"])]

    # Accounts, transactions and tickets: a new batch on top of all earlier ones is merged
    # into the partitions it touches, at a cost that does not grow with the batches before;
    # after a rerun or a failure in between they are rebuilt from Bronze.  A folder per
    # batch marks which ones Silver holds.
    applied = f"{warehouse}/silver/applied"
    merging = bool(landed) and committed_subdirs(spark, applied, "batch=") == landed and cfg.batch_id not in landed
    if not merging:
        delete_folder(spark, applied)
    schema = {}
    for name, (source, key, by) in Lake.MERGED.items():
        paths[name] = f"{warehouse}/silver/{name}"
        rows = Lake.clean(name, (today if merging else bz)[source].drop("_month"), cfg)
        schema[name] = rows.schema
        table = KeyedTable(spark, paths[name], key, by)
        bring = table.merge if merging else table.rebuild
        actions.append(lambda bring=bring, rows=rows: bring(rows, cfg.batch_id))
    run_concurrently(actions)
    for batch in sorted({*landed, cfg.batch_id}):
        spark.range(0).write.mode("overwrite").parquet(f"{applied}/batch={batch}")

    lake._tables["silver_branches"] = spark.read.schema(branches.schema).parquet(paths["silver_branches"])
    for name in Lake.MERGED:
        lake._tables[name] = Lake.shown(name, spark.read.schema(schema[name]).parquet(paths[name]), cfg)

    # DQ on Silver, audit append, gate before Gold
    dq_path = f"{warehouse}/audit/dq_results"
    quality.append_audit(quality.run_suites(lake, cfg), dq_path)
    latest = quality.read_audit(spark, dq_path).where(F.col("batch_id") == cfg.batch_id)
    decision = quality.enforce_gate(latest, cfg)

    # Gold marts: transactions are aggregated once, into the monthly mart that the
    # customer KPIs roll up; segment metrics read the written Customer 360 mart
    gold_root = f"{warehouse}/gold"
    lake.write_concurrently(gold_root, ["txn_monthly_summary", "support_kpis"])
    lake.write_concurrently(gold_root, ["customer_360"])
    lake.write_concurrently(gold_root, ["segment_metrics"])
    paths.update({n: f"{gold_root}/{n}" for n in Lake.GOLD})

    # Serving copies of the four marts and the audit: typed rows and rejects with reasons
    staged = {**{n: lake._tables[n] for n in Lake.GOLD}, "dq_results": latest}
    for name in staged:
        paths[f"serving_{name}"] = f"{warehouse}/serving/{name}"
    run_concurrently([(lambda n=n, d=d: serving.load(d, n, paths[f"serving_{n}"], cfg))
                      for n, d in staged.items()])
    return RunResult(paths=paths, dq=decision, ingest=counts)
