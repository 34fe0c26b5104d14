"""A hot key holding a third of all rows: results stay exact and the
map-side partial steps (aggregate, WindowGroupLimit) stay in the plan."""

from datetime import date, timedelta

import pandas as pd
from pyspark.sql import functions as F

from bankmart.config import RunConfig
from bankmart.operators import gold
from bankmart.operators.dedup import dedup_latest

N = 30_000


def _txns(spark):
    rows = []
    for i in range(N):
        cust = "hot" if i % 3 == 0 else f"c{i % 997}"
        rows.append((f"t{i}", cust, round((i % 500) * 1.25 + 0.01, 2),
                     "Debit" if i % 2 else "Credit", date(2001, 1, 1) + timedelta(days=i % 300),
                     i % 41 == 0, (i % 10) / 10.0, ["Web", "ATM", "Mobile"][i % 3]))
    schema = ("transaction_id string, customer_id string, amount double, direction string, "
              "transaction_date date, is_flagged boolean, fraud_score double, channel string")
    return spark.createDataFrame(rows, schema).repartition(8), pd.DataFrame(
        rows, columns=[c.split()[0] for c in schema.split(", ")])


def test_hot_customer_kpis_exact(spark):
    df, pdf = _txns(spark)
    got = {r["customer_id"]: r for r in gold.txn_kpis(df, RunConfig()).collect()}
    hot = pdf[pdf.customer_id == "hot"]
    assert got["hot"]["total_transactions"] == len(hot) == N // 3
    spend = round(hot.loc[hot.direction == "Debit", "amount"].sum(), 2)
    assert abs(got["hot"]["total_spend_12m"] - spend) < 1e-6
    assert got["hot"]["distinct_channels_used"] == hot.channel.nunique()
    assert got["hot"]["flagged_txn_count"] == int(hot.is_flagged.sum())
    assert len(got) == pdf.customer_id.nunique()
    plan = gold.txn_kpis(df)._jdf.queryExecution().executedPlan().toString()
    # partial aggregation happens before the exchange (map-side combine)
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(customer_id")


def test_hot_duplicate_key_dedup(spark):
    # one transaction id repeated for a third of the rows
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("dup")).otherwise(F.col("id").cast("string"))
         .alias("transaction_id"),
        F.col("id").alias("seq")).repartition(8)
    out = dedup_latest(df, ["transaction_id"], [("seq", "desc")])
    rows = {r["transaction_id"]: r["seq"] for r in out.collect()}
    assert rows["dup"] == max(i for i in range(N) if i % 3 == 0)
    assert len(rows) == N - N // 3 + 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # partial (map side, below the exchange) + final WindowGroupLimit
    assert final.count("WindowGroupLimit") == 2
    assert final.rindex("WindowGroupLimit") > final.index("Exchange hashpartitioning(transaction_id")
