"""The daily batch end to end: idempotent rerun, a second batch, gate."""

import dataclasses
from datetime import date, datetime

from pyspark.sql import functions as F

from bankmart.config import RunConfig
from bankmart.operators import scd2, serving
from bankmart.plans import daily
from bankmart.plans.jobs import bronze_schema
from bankmart.session import scratch_path
from tests.conftest import SMALL


def test_daily_batch_rerun_and_next_day(spark):
    wh = scratch_path(spark, "warehouse")
    cfg = RunConfig(abort_on_failure=False)
    r1 = daily.run(spark, SMALL, wh, cfg)
    c360 = spark.read.parquet(r1.paths["customer_360"])
    assert c360.count() == 150
    n_txn = spark.read.schema(bronze_schema("transactions", ["_month"])) \
        .parquet(f"{wh}/bronze/transactions").count()

    daily.run(spark, SMALL, wh, cfg)                    # same batch again
    assert spark.read.schema(bronze_schema("transactions", ["_month"])) \
        .parquet(f"{wh}/bronze/transactions").count() == n_txn
    assert scd2.store_batches(spark, f"{wh}/silver/customers_scd2") == [cfg.batch_id]

    nxt = dataclasses.replace(cfg, as_of=date(2001, 11, 5), run_ts=datetime(2001, 11, 5),
                              batch_id="20011105_000000")
    r2 = daily.run(spark, SMALL, wh, nxt, tune=True)
    bz = spark.read.schema(bronze_schema("transactions", ["_month"])) \
        .parquet(f"{wh}/bronze/transactions")
    assert bz.count() == 2 * n_txn
    assert bz.select("_batch_id").distinct().count() == 2
    # Silver keeps one row per transaction id across both batches
    silver_txn = spark.read.parquet(r2.paths["silver_transactions"])
    assert silver_txn.count() == silver_txn.select("transaction_id").distinct().count()
    # unchanged customers: no new SCD2 versions, one current row per key
    store = spark.read.parquet(f"{wh}/silver/customers_scd2")
    assert store.where(~F.col("scd_is_current")).count() == 0
    assert store.where(F.col("batch") == "20011105_000000").count() == 150
    audit = spark.read.parquet(f"{wh}/audit/dq_results")
    assert audit.select("batch_id").distinct().count() == 2
    assert audit.count() == 2 * 32                          # the rerun replaced its own rows
    assert spark.read.parquet(r2.paths["customer_360"]).count() == 150
    assert serving.read_loaded(spark, f"{wh}/serving/customer_360", "customer_360").count() == 150


def test_queries_on_the_written_warehouse(spark):
    from bankmart.plans import catalogue
    from bankmart.plans.lake import Lake
    from tools.oracle_check import rows_of
    wh = scratch_path(spark, "warehouse-q")
    daily.run(spark, SMALL, wh, RunConfig(abort_on_failure=False))
    catalogue.queries()
    on_wh = Lake.from_warehouse(spark, wh, sf_dir=SMALL)
    lazy = Lake(spark, SMALL)
    for key in ["q1_segment_summary", "q2_churn_top100", "v5_monthly_trend", "q10_dq_latest",
                "v7_support_ops", "customer_360", "dq_gate"]:
        a = catalogue.display_form(catalogue.QUERIES[key](on_wh))
        b = catalogue.display_form(catalogue.QUERIES[key](lazy))
        assert rows_of(a.columns, [tuple(r) for r in a.collect()]) == \
            rows_of(b.columns, [tuple(r) for r in b.collect()]), key
