"""Registered SCD2 queries over the customer change log, and the
point-in-time reads of a multi-batch Bronze table."""

from __future__ import annotations

import dataclasses
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart import domains as D
from bankmart.operators import bronze as B
from bankmart.operators import scd2 as S
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake
from bankmart.session import partition_values, scratch_path
from bankmart.sources.adapters import customer_change_log



# parameters of the SCD2 demonstrations
CUT = date(1998, 6, 30)                  # the dimension is loaded as of this day, the batch is the whole log
AS_OF_PROBE = date(1998, 6, 30)
SNAPSHOT_BATCH = "19990101_000000"
SNAPSHOT_INSTANTS = ("1990-01-01 00:00:00", "1997-01-01 00:00:00", "1998-12-31 23:59:59", "2030-06-01 12:00:00")
TRACKED = tuple(D.SCD2_TRACKED)


def history(lake: Lake) -> DataFrame:
    return S.scd2_history(customer_change_log(lake.spark, lake.sf_dir), tracked=TRACKED)


def yearly(lake: Lake) -> DataFrame:
    return S.yearly_batches(customer_change_log(lake.spark, lake.sf_dir), tracked=TRACKED)


def states(lake: Lake, until: date | None = None) -> DataFrame:
    """Every customer's last state in the change log (up to a day)."""
    log = customer_change_log(lake.spark, lake.sf_dir)
    if until is not None:
        log = log.where(F.col("effective_date") <= F.lit(until))
    last = F.max_by(F.struct(*TRACKED), F.struct("effective_date", "seq")).alias("s")
    return log.groupBy("customer_id").agg(last).select("customer_id", "s.*")


def initial_dim(lake: Lake) -> DataFrame:
    return S.scd2_initial(states(lake, CUT), dataclasses.replace(lake.cfg, as_of=CUT))


@query("scd2_history")
def scd2_history_q(lake: Lake) -> DataFrame:
    return history(lake)


@query("scd2_current")
def scd2_current(lake: Lake) -> DataFrame:
    return S.current_rows(history(lake))


@query("scd2_as_of")
def scd2_as_of_q(lake: Lake) -> DataFrame:
    return S.scd2_as_of(history(lake), AS_OF_PROBE)


@query("scd2_counts")
def scd2_counts_q(lake: Lake) -> DataFrame:
    return S.scd2_counts(history(lake))


@query("scd2_initial")
def scd2_initial_q(lake: Lake) -> DataFrame:
    """First load of every customer's last state."""
    return S.scd2_initial(states(lake), lake.cfg)


@query("scd2_new_keys")
def scd2_new_keys_q(lake: Lake) -> DataFrame:
    return S.scd2_new_keys(initial_dim(lake), states(lake))


@query("scd2_changed_keys")
def scd2_changed_keys_q(lake: Lake) -> DataFrame:
    return S.scd2_changed_keys(initial_dim(lake), states(lake), tracked=TRACKED)



def multi_batch_bronze(lake: Lake) -> str:
    """Append-only customer Bronze on disk, one batch per year of changes; its folder."""
    spark, states, root = lake.spark, scratch_path(lake.spark, "bronze-states"), scratch_path(lake.spark, "bronze-years")
    y = yearly(lake)
    y.hint("rebalance", "batch_date").write.partitionBy("batch_date").parquet(states)
    schema = T.StructType([f for f in y.schema.fields if f.name != "batch_date"])
    for day in map(date.fromisoformat, partition_values(spark, states, "batch_date=")):
        cfg = dataclasses.replace(lake.cfg, as_of=day, run_ts=datetime(day.year, day.month, day.day),
                                  batch_id=day.strftime("%Y%m%d_000000"))
        rows = spark.read.schema(schema).parquet(f"{states}/batch_date={day}")
        B.append(B.stamp(rows, "CRM", "customers.csv", cfg), root, cfg.batch_id)
    return root


@query("snapshot_as_of")
def snapshot_as_of(lake: Lake) -> DataFrame:
    """State of every customer as of a batch and as of several instants."""
    return B.snapshot_as_of(lake.spark, multi_batch_bronze(lake), "customer_id", [SNAPSHOT_BATCH], SNAPSHOT_INSTANTS)


@query("batch_ledger")
def batch_ledger(lake: Lake) -> DataFrame:
    return B.batch_ledger(B.read_bronze(lake.spark, multi_batch_bronze(lake)))
