"""Serving views V1–V7 and the cross-mart sanity union (S1).

Each view is a function returning a DataFrame; ``register_views`` also
publishes them as temporary views for SQL users and BI tools.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart import domains as D
from bankmart.functions.exact import exact_avg, exact_sum
from bankmart.functions.lookup import case_map
from bankmart.plans.analytics import (whole, customer_name, flag_count, holds,
                                      is_false, is_true, monthly_rollup)
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake


def _verified(df: DataFrame) -> DataFrame:
    return df.where(F.col("kyc_status") == "Verified")


@query("v1_executive_kpis")
def v1_executive_kpis(lake: Lake) -> DataFrame:
    n = F.count(F.lit(1))
    return _verified(lake.customer_360).agg(
        n.alias("total_customers"),
        F.round(exact_sum("total_balance") / 1e9, 3).alias("aum_billions"),
        F.round(F.avg("credit_score"), 0).alias("avg_credit_score"),
        F.round(exact_avg("tenure_years"), 1).alias("avg_tenure_years"),
        flag_count("high_value_flag").alias("high_value_customers"),
        flag_count("churn_risk_flag").alias("churn_risk_customers"),
        F.round(F.avg("product_diversity_count"), 2).alias("avg_products_per_customer"),
        F.round(exact_sum("total_spend_12m") / 1e6, 2).alias("total_spend_12m_millions"),
        F.round(exact_avg("avg_csat_score"), 2).alias("portfolio_avg_csat"),
        F.round(flag_count("churn_risk_flag") * 100.0 / n, 1).alias("churn_risk_pct"),
    ).withColumn("refreshed_at", lake.cfg.run_ts_col())


@query("v2_segment_breakdown")
def v2_segment_breakdown(lake: Lake) -> DataFrame:
    s = lake.segment_metrics
    return (s.select(
                "segment", "customer_count",
                F.round(F.col("customer_count") * 100.0
                        / F.sum("customer_count").over(whole()), 1).alias("pct_of_customers"),
                F.round(F.col("aum_total") / 1e6, 2).alias("aum_millions"),
                F.round(F.col("aum_total") * 100.0 / F.sum("aum_total").over(whole()), 1)
                 .alias("pct_of_aum"),
                F.round("avg_total_balance", 0).alias("avg_balance"),
                F.round("avg_credit_score", 0).alias("avg_credit_score"),
                F.round("avg_products_held", 2).alias("avg_products"),
                F.round("avg_spend_12m", 0).alias("avg_spend_12m"),
                "churn_risk_pct", "high_value_pct",
                F.round("avg_csat", 2).alias("avg_csat"),
                F.round("avg_tenure_years", 1).alias("avg_tenure_yrs"),
                "aum_total")
            .orderBy(F.col("aum_total").desc()).drop("aum_total"))


@query("v3_geography")
def v3_geography(lake: Lake) -> DataFrame:
    return (lake.customer_360.groupBy("state").agg(
                F.count(F.lit(1)).alias("customer_count"),
                F.round(exact_sum("total_balance") / 1e6, 2).alias("aum_millions"),
                F.round(F.avg("credit_score"), 0).alias("avg_credit_score"),
                F.round(exact_avg("annual_income"), 0).alias("avg_income"),
                flag_count("churn_risk_flag").alias("churn_risk_count"),
                flag_count("high_value_flag").alias("high_value_count"),
                F.round(F.avg("product_diversity_count"), 2).alias("avg_products"),
                F.round(exact_avg("avg_csat_score"), 2).alias("avg_csat"))
            .orderBy(F.col("aum_millions").desc()))


def churn_priority_detailed() -> Column:
    days, csat = F.col("days_since_last_txn"), F.col("avg_csat_score")
    esc, bal = F.col("escalated_tickets"), F.col("total_balance")
    p = D.PRIORITY_DETAILED
    return (F.when((days > D.CRITICAL_INACTIVE_DAYS) & (bal > D.HIGH_VALUE_AT_RISK_BALANCE), p[0])
             .when(days > D.CRITICAL_INACTIVE_DAYS, p[1])
             .when((csat < D.LOW_CSAT) & (esc > 0), p[2])
             .when(csat < D.LOW_CSAT, p[3])
             .when(esc > D.CHURN_MAX_ESCALATIONS, p[4])
             .otherwise(p[5]))


def recommended_action() -> Column:
    return case_map(F.col("preferred_channel"), D.CHANNEL_ACTIONS, D.DEFAULT_ACTION)


@query("v4_churn_detail")
def v4_churn_detail(lake: Lake) -> DataFrame:
    return (_verified(lake.customer_360).where(is_true("churn_risk_flag"))
            .select("customer_id", customer_name(), "email", "segment", "age_band",
                    "income_tier", "state",
                    F.round("total_balance", 0).alias("total_balance"),
                    F.round("total_spend_12m", 0).alias("spend_12m"),
                    "days_since_last_txn",
                    F.round("avg_csat_score", 1).alias("csat_score"),
                    "escalated_tickets", "total_tickets", "preferred_channel",
                    churn_priority_detailed().alias("churn_priority"),
                    recommended_action().alias("recommended_action"))
            .orderBy(F.col("total_balance").desc()))


@query("v5_monthly_trend")
def v5_monthly_trend(lake: Lake) -> DataFrame:
    """Month-over-month change.  The LAG window is global but runs on one
    row per month."""
    m = monthly_rollup(lake.txn_monthly_summary, 3).withColumnRenamed("_flagged", "flagged_txns")
    w = Window.orderBy("txn_year", "txn_month")
    prev = F.lag("_spend", 1).over(w)
    return (m.withColumns({
                "prev_month_spend": prev,
                "spend_mom_pct_change": F.round((F.col("_spend") - prev) * 100.0
                                                / F.nullif(prev, F.lit(0.0)), 1)})
             .drop("_spend")
             .orderBy("txn_year", "txn_month"))


def opportunity(lacks: str, extra: Column | None = None) -> Column:
    cond = ~holds(lacks) if extra is None else (~holds(lacks) & extra)
    return F.when(cond, True).otherwise(False)


@query("v6_cross_sell")
def v6_cross_sell(lake: Lake) -> DataFrame:
    c = (_verified(lake.customer_360)
         .where(is_false("churn_risk_flag")
                & F.col("segment").isin("Retail", "Premier", "Private")))
    out = c.select(
        "customer_id", customer_name(), "segment", "income_tier", "credit_band",
        F.round("total_balance", 0).alias("total_balance"),
        F.round("annual_income", 0).alias("annual_income"),
        "product_diversity_count", "product_types_held", "preferred_channel",
        "tenure_years",
        opportunity("Investment").alias("investment_opportunity"),
        opportunity("Mortgage", F.col("annual_income") > D.MORTGAGE_MIN_INCOME)
            .alias("mortgage_opportunity"),
        opportunity("Credit Card", F.col("credit_score") > D.CARD_MIN_SCORE)
            .alias("credit_card_opportunity"))
    return (out.where(F.col("investment_opportunity") | F.col("mortgage_opportunity")
                      | F.col("credit_card_opportunity"))
               .orderBy(F.col("total_balance").desc()))


@query("v7_support_ops")
def v7_support_ops(lake: Lake) -> DataFrame:
    """Averages of daily averages and a sum of per-day distinct customers,
    exactly as the serving view defines them."""
    return (lake.support_kpis.groupBy("category", "priority").agg(
                F.sum("ticket_count").alias("total_tickets"),
                F.round(exact_avg("avg_resolution_days"), 1).alias("avg_days_to_resolve"),
                F.round(exact_avg("avg_csat"), 2).alias("avg_csat_score"),
                F.round(exact_avg("resolution_rate"), 1).alias("resolution_rate_pct"),
                F.round(exact_avg("escalation_rate"), 1).alias("escalation_rate_pct"),
                F.sum("escalation_count").alias("total_escalations"),
                F.sum("distinct_customers").alias("customers_affected"))
            .orderBy(F.col("avg_days_to_resolve").desc(), "category"))


@query("sanity_union")
def sanity_union(lake: Lake) -> DataFrame:
    c = lake.customer_360.agg(
        F.lit("customer_360").alias("table_name"), F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("segment").alias("distinct_segments"),
        F.round(exact_sum("total_balance") / 1e6, 2).alias("aum_millions"))
    t = lake.txn_monthly_summary.agg(
        F.lit("txn_monthly_summary").alias("table_name"), F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("period").alias("distinct_segments"),
        F.lit(None).cast("double").alias("aum_millions"))
    s = lake.segment_metrics.agg(
        F.lit("segment_metrics").alias("table_name"), F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("segment").alias("distinct_segments"),
        F.round(exact_sum("aum_total") / 1e6, 2).alias("aum_millions"))
    return c.unionByName(t).unionByName(s)


VIEWS = {
    "vw_executive_kpis": v1_executive_kpis, "vw_segment_breakdown": v2_segment_breakdown,
    "vw_geographic_distribution": v3_geography, "vw_churn_risk_detail": v4_churn_detail,
    "vw_monthly_txn_trend": v5_monthly_trend, "vw_crosssell_opportunities": v6_cross_sell,
    "vw_support_operations": v7_support_ops,
}


def register_views(lake: Lake) -> list[str]:
    """Publish the Silver tables, Gold marts, DQ audit and the seven views
    as temporary views (SQL users and BI tools query them by name)."""
    tables = Lake.SILVER + Lake.GOLD + ["dq_results"]
    for name in tables:
        getattr(lake, name).createOrReplaceTempView(name)
    for name, fn in VIEWS.items():
        fn(lake).createOrReplaceTempView(name)
    return tables + list(VIEWS)
