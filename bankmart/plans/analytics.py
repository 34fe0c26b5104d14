"""Analytics queries Q1–Q10 over the Gold marts, Silver history and the
DQ audit table.

Global windows (``OVER ()``) only ever run on an already aggregated frame
whose size is bounded by a small domain (segments, months), so their
single-partition exchange is cheap; top-k lists use ``orderBy().limit()``
which Spark plans as a per-partition top-k plus a merge
(``TakeOrderedAndProject``), never a full sort.  Every top-k has a unique
tie-break (``customer_id``) so the k rows are well defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart import domains as D
from bankmart.functions.exact import exact_avg, exact_sum
from bankmart.operators.scd2 import scd2_history
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake
from bankmart.sources.adapters import segment_change_log

def whole() -> Window:
    """The whole (already aggregated, bounded) frame as one window."""
    return Window.partitionBy()


def customer_name() -> Column:
    """``first || ' ' || last`` — NULL if either part is NULL."""
    return F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name")


def flag_count(col: str) -> Column:
    return F.sum(F.when(F.col(col), 1).otherwise(0))


def is_true(col: str) -> Column:
    """``col = TRUE``: a NULL flag does not pass (three-valued)."""
    return F.col(col) == F.lit(True)


def is_false(col: str) -> Column:
    return F.col(col) == F.lit(False)


@query("q1_segment_summary")
def q1_segment_summary(lake: Lake) -> DataFrame:
    seg = lake.customer_360.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.round(exact_avg("total_balance"), 0).alias("avg_balance"),
        F.round(F.avg("credit_score"), 0).alias("avg_credit_score"),
        F.round(exact_sum("total_balance") / 1e6, 2).alias("aum_millions"),
        F.round(exact_avg("tenure_years"), 1).alias("avg_tenure_yrs"),
        F.round(F.avg("product_diversity_count"), 1).alias("avg_products_held"))
    return (seg.withColumn("pct_of_total",
                           F.round(F.col("customer_count") * 100.0
                                   / F.sum("customer_count").over(whole()), 1))
               .select("segment", "customer_count", "pct_of_total", "avg_balance",
                       "avg_credit_score", "aum_millions", "avg_tenure_yrs", "avg_products_held")
               .orderBy(F.col("aum_millions").desc()))


def churn_priority_short() -> Column:
    days, csat = F.col("days_since_last_txn"), F.col("avg_csat_score")
    return (F.when(days > D.CRITICAL_INACTIVE_DAYS, D.PRIORITY_SHORT[0])
             .when(days > D.CHURN_INACTIVE_DAYS, D.PRIORITY_SHORT[1])
             .when(csat < D.LOW_CSAT, D.PRIORITY_SHORT[1])
             .otherwise(D.PRIORITY_SHORT[2]))


@query("q2_churn_top100")
def q2_churn_top100(lake: Lake, k: int = 100) -> DataFrame:
    return (lake.customer_360.where(is_true("churn_risk_flag"))
            .select("customer_id", customer_name(), "segment", "credit_band",
                    F.round("total_balance", 0).alias("total_balance"),
                    "days_since_last_txn",
                    F.round("avg_csat_score", 1).alias("csat"),
                    "escalated_tickets", "total_tickets",
                    churn_priority_short().alias("churn_priority"))
            .orderBy(F.col("total_balance").desc(),
                     F.col("days_since_last_txn").desc_nulls_last(), "customer_id")
            .limit(k))


@query("q3_high_value")
def q3_high_value(lake: Lake, k: int = 50) -> DataFrame:
    c = lake.customer_360
    return (c.where(is_true("high_value_flag") & (F.col("kyc_status") == "Verified"))
            .select("customer_id", customer_name(), "segment", "age_band", "income_tier",
                    "state", F.round("total_balance", 0).alias("total_balance"),
                    "active_account_count", "product_diversity_count",
                    F.round("total_spend_12m", 0).alias("spend_12m"),
                    F.round("net_cash_flow_12m", 0).alias("net_cash_flow"),
                    "preferred_channel",
                    F.round("avg_csat_score", 2).alias("csat_score"), "tenure_years")
            .orderBy(F.col("total_balance").desc(), "customer_id")
            .limit(k))


def monthly_rollup(monthly: DataFrame, digits: int) -> DataFrame:
    """Per-month totals of the monthly mart.  The mart's grain is (customer,
    year, month), so within a month each customer occurs at most once and
    COUNT(DISTINCT customer_id) equals the non-null count — no distinct
    aggregation (and its shuffle of every (month, customer) pair) needed."""
    return monthly.groupBy("period", "txn_year", "txn_month").agg(
        F.sum("txn_count").alias("total_transactions"),
        F.round(exact_sum("total_debit") / 1e6, digits).alias("total_spend_millions"),
        F.round(exact_sum("total_credit") / 1e6, digits).alias("total_deposits_millions"),
        F.round(exact_sum("net_flow") / 1e6, digits).alias("net_flow_millions"),
        F.count("customer_id").alias("active_customers"),
        F.round(exact_avg("avg_txn_amount"), 2).alias("avg_txn_size"),
        F.sum("flagged_count").alias("_flagged"),
        exact_sum("total_debit").alias("_spend"))


@query("q4_monthly_trend")
def q4_monthly_trend(lake: Lake) -> DataFrame:
    return (monthly_rollup(lake.txn_monthly_summary, 2)
            .withColumnRenamed("_flagged", "flagged_transactions").drop("_spend")
            .orderBy("txn_year", "txn_month"))


@query("q5_geography")
def q5_geography(lake: Lake) -> DataFrame:
    return (lake.customer_360.groupBy("state").agg(
                F.count(F.lit(1)).alias("customer_count"),
                F.round(exact_sum("total_balance") / 1e6, 2).alias("aum_millions"),
                F.round(F.avg("credit_score"), 0).alias("avg_credit_score"),
                flag_count("churn_risk_flag").alias("churn_risk_count"),
                flag_count("high_value_flag").alias("high_value_count"))
            .orderBy(F.col("aum_millions").desc()))


def holds(product: str) -> Column:
    return F.array_contains(F.col("product_types_held"), product)


@query("q6_cross_sell")
def q6_cross_sell(lake: Lake, k: int = 200) -> DataFrame:
    return (lake.customer_360
            .where(F.col("segment").isin("Retail", "Premier")
                   & holds("Checking") & ~holds("Investment")
                   & (F.col("kyc_status") == "Verified")
                   & (F.col("annual_income") > D.CROSS_SELL_MIN_INCOME)
                   & is_false("churn_risk_flag"))
            .select("customer_id", customer_name(), "segment",
                    F.round("total_balance", 0).alias("total_balance"),
                    F.round("annual_income", 0).alias("annual_income"),
                    "income_tier", "product_diversity_count", "credit_score", "tenure_years")
            .orderBy(F.col("total_balance").desc(), "customer_id")
            .limit(k))


@query("q7_ticket_kpis")
def q7_ticket_kpis(lake: Lake) -> DataFrame:
    """``total_tickets`` counts (day, category, priority) groups, as in the
    source query; ``total_volume`` is the ticket count."""
    return (lake.support_kpis.groupBy("category").agg(
                F.count(F.lit(1)).alias("total_tickets"),
                F.round(exact_avg("avg_resolution_days"), 1).alias("avg_resolution_days"),
                F.round(exact_avg("avg_csat"), 2).alias("avg_csat"),
                F.round(exact_avg("resolution_rate"), 1).alias("resolution_rate_pct"),
                F.round(exact_avg("escalation_rate"), 1).alias("escalation_rate_pct"),
                F.sum("ticket_count").alias("total_volume"))
            .orderBy(F.col("avg_resolution_days").desc()))


def segment_history(lake: Lake) -> DataFrame:
    """SCD2 history of customers' segments."""
    return scd2_history(segment_change_log(lake.spark, lake.sf_dir))


@query("q8_segment_changes")
def q8_segment_changes(lake: Lake) -> DataFrame:
    since = F.add_months(F.lit(lake.cfg.changes_as_of), -12)
    return (segment_history(lake)
            .where((F.col("scd_version") > 1) & (F.col("scd_start_date") >= since))
            .select("customer_id", F.col("segment").alias("new_segment"),
                    "scd_start_date", "scd_end_date", "scd_version", "scd_is_current")
            .orderBy("customer_id", "scd_version"))


@query("q9_fraud_exposure")
def q9_fraud_exposure(lake: Lake) -> DataFrame:
    return (lake.customer_360.where(F.col("flagged_txn_count") > 0)
            .groupBy("segment").agg(
                # one row per customer in the mart: distinct count = count
                F.count("customer_id").alias("customers_with_flags"),
                F.sum("flagged_txn_count").alias("total_flagged_txns"),
                F.round(exact_avg("avg_fraud_score"), 4).alias("avg_fraud_score"),
                F.round(exact_sum("total_spend_12m"), 0).alias("total_spend"),
                F.round(F.sum("flagged_txn_count") * 100.0
                        / F.nullif(F.sum("total_transactions"), F.lit(0)), 2)
                 .alias("flagged_txn_pct"))
            .orderBy(F.col("total_flagged_txns").desc()))


@query("q10_dq_latest")
def q10_dq_latest(lake: Lake) -> DataFrame:
    return latest_dq_run(lake.dq_results)


def latest_dq_run(dq: DataFrame) -> DataFrame:
    """Rows of the newest batch (uncorrelated scalar subquery)."""
    latest = dq.select(F.max("batch_id")).scalar()
    return (dq.where(F.col("batch_id") == latest)
              .select("table_name", "check_name", "status", "failing_count",
                      "total_count", "pass_pct", "run_ts")
              .orderBy(F.col("status").desc(), "table_name", "check_name"))
