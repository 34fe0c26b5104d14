"""Registered queries over the layers themselves: sources, Bronze, Silver,
Gold marts and their building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import dataclasses
from datetime import date

from bankmart.operators import bronze as B
from bankmart.operators import gold
from bankmart.operators.dedup import dedup_latest, INGEST_ORDER
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake
from bankmart.session import scratch_path
from bankmart.sources.adapters import (TRANSACTION_TIE_BREAK, customers_extract,
                                       transactions_extract)


@query("account_kpis")
def account_kpis(lake: Lake) -> DataFrame:
    return gold.account_kpis(lake.silver_accounts)


@query("txn_kpis")
def txn_kpis(lake: Lake) -> DataFrame:
    return gold.txn_kpis(lake.silver_transactions, lake.cfg)


@query("ticket_kpis")
def ticket_kpis(lake: Lake) -> DataFrame:
    return gold.ticket_kpis(lake.silver_tickets)


@query("customer_360")
def customer_360(lake: Lake) -> DataFrame:
    return lake.customer_360


@query("txn_monthly_summary")
def txn_monthly_summary(lake: Lake) -> DataFrame:
    return lake.txn_monthly_summary


@query("segment_metrics")
def segment_metrics(lake: Lake) -> DataFrame:
    return lake.segment_metrics


@query("support_kpis")
def support_kpis(lake: Lake) -> DataFrame:
    return lake.support_kpis


@query("silver_customers")
def silver_customers(lake: Lake) -> DataFrame:
    return lake.silver_customers


@query("silver_accounts")
def silver_accounts(lake: Lake) -> DataFrame:
    return lake.silver_accounts


@query("silver_transactions")
def silver_transactions(lake: Lake) -> DataFrame:
    return lake.silver_transactions


@query("silver_branches")
def silver_branches(lake: Lake) -> DataFrame:
    return lake.silver_branches


@query("silver_tickets")
def silver_tickets(lake: Lake) -> DataFrame:
    return lake.silver_tickets


# ── Bronze and layer-level queries ──────────────────────────────────────────
@query("bronze_stamp")
def bronze_stamp(lake: Lake) -> DataFrame:
    return lake.bronze("customers")


@query("table_scan")
def table_scan(lake: Lake) -> DataFrame:
    return transactions_extract(lake.spark, lake.sf_dir, lake.cfg)


@query("dedup_latest")
def dedup_latest_q(lake: Lake) -> DataFrame:
    d = dedup_latest(lake.bronze("transactions"), ["transaction_id"],
                     INGEST_ORDER + TRANSACTION_TIE_BREAK)
    return d.select("transaction_id", "transaction_date", "reference_number", "amount")


@query("schema_evolve")
def schema_evolve(lake: Lake) -> DataFrame:
    """Two Bronze batches on disk: the second adds ``loyalty_tier`` and widens
    ``credit_score``; both are read in the merged schema."""
    ext = customers_extract(lake.spark, lake.sf_dir, lake.cfg)
    even = F.col("customer_id").cast("long") % 2 == 0
    cfg1 = dataclasses.replace(lake.cfg, batch_id="20011103_000000", as_of=date(2001, 11, 3))
    second = ext.where(~even).withColumn("credit_score", F.col("credit_score").cast("long")).withColumn(
        "loyalty_tier", F.when(F.col("credit_score") >= 740, "Gold").otherwise("Standard"))
    path = scratch_path(lake.spark, "bronze-evolved")
    B.append(B.stamp(ext.where(even), "CRM", "customers.csv", cfg1), path, cfg1.batch_id)
    B.append(B.stamp(second, "CRM", "customers.csv", lake.cfg), path, lake.cfg.batch_id)
    return B.read_bronze(lake.spark, path)


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows of written Parquet tables from their files' footers: COUNT(*) is pushed into
    the scan (``PushedAggregation`` in the plan), so no row is read."""
    own = spark.newSession()               # these settings stay out of the caller's session
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    out = None
    for name, path in paths.items():
        c = own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def row_counts(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    """Table → rows (one number per table; a table without row groups has none)."""
    return {r["name"]: r["row_count"] or 0 for r in footer_counts(spark, paths).collect()}


def written_tables(lake: Lake) -> dict[str, str]:
    """Folders of the lake's Silver and Gold tables; a lake that has none is written first,
    each table once and as it comes: counts do not need a layout."""
    names = Lake.SILVER + Lake.GOLD
    lake = lake.written_once(names)
    return {n: lake.paths[n] for n in names}


@query("layer_audit")
def layer_audit(lake: Lake) -> DataFrame:
    """Row count per table, a TOTAL per layer and an overall total, rolled up from one union
    of counts.  Silver and Gold are counted from the footers of the written tables, the
    sources that Bronze lands by one scan each."""
    bronze = {n: lake.bronze(n) for n in ["customers", "accounts", "transactions", "branches", "support_tickets"]}
    counts = None
    for name, df in bronze.items():
        c = df.agg(F.lit("bronze").alias("layer"), F.lit(name).alias("table_name"),
                   F.count(F.lit(1)).alias("row_count"))
        counts = c if counts is None else counts.unionByName(c)
    stored = lake.written_once(Lake.SILVER + Lake.GOLD)
    layers = [("silver" if name in Lake.SILVER else "gold", name, n)
              for name, n in row_counts(lake.spark, written_tables(stored)).items()]
    stored.drop_written(Lake.SILVER + Lake.GOLD)
    counts = counts.unionByName(lake.spark.createDataFrame(
        layers, "layer string, table_name string, row_count long"))
    r = counts.rollup("layer", "table_name").agg(F.sum("row_count").alias("row_count"),
                                                 F.grouping_id().alias("_g"))
    return r.select(F.coalesce("layer", F.lit("ALL")).alias("layer"),
                    F.when(F.col("_g") > 0, F.lit("TOTAL")).otherwise(F.col("table_name"))
                     .alias("table_name"),
                    F.col("row_count").cast("long").alias("row_count"))


@query("pk_check")
def pk_check(lake: Lake) -> DataFrame:
    """Declared primary keys of the serving tables: uniqueness before load."""
    out = None
    for table, key in [("customer_360", "customer_id"), ("segment_metrics", "segment")]:
        k = F.col(key)
        c = getattr(lake, table).agg(
            F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(k).alias("distinct_keys"),
            F.count_if(k.isNull()).alias("null_keys"))
        out = c if out is None else out.unionByName(c)
    return out.withColumn("is_unique", (F.col("row_count") == F.col("distinct_keys"))
                          & (F.col("null_keys") == 0))


@query("c360_sample")
def c360_sample(lake: Lake, n: int = 3) -> DataFrame:
    return (lake.customer_360.orderBy("customer_id")
            .select("first_name", "last_name", "segment", "total_balance", "credit_score",
                    "total_transactions", "churn_risk_flag", "high_value_flag")
            .limit(n))


PRUNE_YEAR, PRUNE_MONTH = 1998, 3


# ── bands and flags (as applied in Silver / Gold) ───────────────────────────
@query("band_age")
def band_age(lake: Lake) -> DataFrame:
    return lake.silver_customers.select("customer_id", "age", "age_band")


@query("band_income")
def band_income(lake: Lake) -> DataFrame:
    return lake.silver_customers.select("customer_id", "annual_income", "income_tier")


@query("band_credit")
def band_credit(lake: Lake) -> DataFrame:
    return lake.silver_customers.select("customer_id", "credit_score", "credit_band")


@query("churn_flag")
def churn_flag_q(lake: Lake) -> DataFrame:
    return lake.customer_360.select("customer_id", "days_since_last_txn", "avg_csat_score",
                                    "escalated_tickets", "churn_risk_flag")


@query("high_value_flag")
def high_value_flag_q(lake: Lake) -> DataFrame:
    return lake.customer_360.select("customer_id", "total_balance", "segment",
                                    "high_value_flag")
