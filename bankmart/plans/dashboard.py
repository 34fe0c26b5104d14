"""Dashboard queries (the BI pages' visuals) and lookup joins.

Parameters that a report slicer would supply are keyword arguments with
defaults, so every query is runnable as registered.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart import domains as D
from bankmart.functions.bands import band, lower_bound_band
from bankmart.functions.exact import exact_avg, exact_sum
from bankmart.operators.joins import lookup_join
from bankmart.plans.analytics import whole, customer_name, is_true, q7_ticket_kpis
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake
from bankmart.plans.views import (v1_executive_kpis, v4_churn_detail,
                                  v5_monthly_trend)

# default slicer / lookup values
LOOKUP_NAME = "Customer 000000007"
LOOKUP_CUSTOMER = "7"
BALANCE_TIERS = [(10_000, "<10k"), (100_000, "10k-100k"), (None, "100k+")]


@query("trend_last_12")
def trend_last_12(lake: Lake, months: int = 12) -> DataFrame:
    """Spend trend, last ``months`` periods, oldest first."""
    v5 = v5_monthly_trend(lake)
    last = (v5.orderBy(F.col("txn_year").desc(), F.col("txn_month").desc()).limit(months))
    return (last.select("period", "txn_year", "txn_month", "total_spend_millions")
                .orderBy("txn_year", "txn_month"))


@query("sliced_kpis")
def sliced_kpis(lake: Lake, segments=("Retail", "Premier"), states=None,
                active_between=(date(2000, 1, 1), date(2001, 12, 31)),
                tiers=("10k-100k", "100k+"), priorities=None) -> DataFrame:
    """KPIs under the report slicers: segment, state, activity date range,
    balance tier (tier thresholds are a parameter) and churn priority level."""
    c = lake.customer_360.withColumn("balance_tier", band("total_balance", BALANCE_TIERS))
    cond = F.lit(True)
    if segments:
        cond = cond & F.col("segment").isin(*segments)
    if states:
        cond = cond & F.col("state").isin(*states)
    if active_between:
        lo, hi = active_between
        cond = cond & F.col("last_transaction_date").between(F.lit(lo), F.lit(hi))
    if tiers:
        cond = cond & F.col("balance_tier").isin(*tiers)
    if priorities:
        from bankmart.plans.views import churn_priority_detailed
        cond = cond & is_true("churn_risk_flag") & churn_priority_detailed().isin(*priorities)
    return (c.where(cond).groupBy("segment", "balance_tier").agg(
                F.count(F.lit(1)).alias("customer_count"),
                F.round(exact_sum("total_balance") / 1e6, 2).alias("aum_millions"),
                F.round(F.avg("credit_score"), 0).alias("avg_credit_score"),
                F.sum(F.when(F.col("churn_risk_flag"), 1).otherwise(0)).alias("churn_risk_count"))
            .orderBy("segment", "balance_tier"))


def credit_color(score: Column) -> Column:
    return (F.when(score >= D.CREDIT_COLOR_GREEN, "Green")
             .when(score >= D.CREDIT_COLOR_AMBER, "Amber").otherwise("Red"))


@query("customer_profile")
def customer_profile(lake: Lake, name: str = LOOKUP_NAME) -> DataFrame:
    c = lake.customer_360
    return (c.where(F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")) == name)
             .select("customer_id", customer_name(), "segment", "age_band", "state",
                     "kyc_status", "preferred_channel", "total_balance",
                     F.col("total_spend_12m").alias("spend_12m"), "credit_score",
                     credit_color(F.col("credit_score")).alias("credit_color"),
                     F.array_join("product_types_held", ", ").alias("products_held")))


@query("customer_monthly")
def customer_monthly(lake: Lake, customer_id: str = LOOKUP_CUSTOMER) -> DataFrame:
    return (lake.txn_monthly_summary.where(F.col("customer_id") == customer_id)
            .select("customer_id", "period", "total_debit").orderBy("period"))


@query("churn_indicators")
def churn_indicators(lake: Lake) -> DataFrame:
    """Which churn trigger fired, per customer (three-valued like the flag)."""
    return lake.customer_360.select(
        "customer_id", "days_since_last_txn", "avg_csat_score", "escalated_tickets",
        (F.col("days_since_last_txn") > D.CHURN_INACTIVE_DAYS).alias("inactive_trigger"),
        (F.col("avg_csat_score") < D.CHURN_MIN_CSAT).alias("csat_trigger"),
        (F.col("escalated_tickets") > D.CHURN_MAX_ESCALATIONS).alias("escalation_trigger"),
        "churn_risk_flag")


@query("customer_tickets")
def customer_tickets(lake: Lake, customer_id: str = LOOKUP_CUSTOMER) -> DataFrame:
    t = lake.silver_tickets.where(F.col("customer_id") == customer_id)
    c = lake.customer_360.where(F.col("customer_id") == customer_id).select(
        "customer_id", customer_name())
    return (t.join(c, "customer_id", "left")
             .select("customer_id", "customer_name", "ticket_id", "category", "status",
                     "created_date", "csat_score", "resolution_days")
             .orderBy(F.col("created_date").desc(), "ticket_id"))


def at_risk(lake: Lake) -> DataFrame:
    return lake.customer_360.where(is_true("churn_risk_flag")
                                   & (F.col("kyc_status") == "Verified"))


@query("at_risk_totals")
def at_risk_totals(lake: Lake) -> DataFrame:
    return at_risk(lake).agg(F.count(F.lit(1)).alias("at_risk_customers"),
                             exact_sum("total_balance").alias("aum_at_risk"))


@query("priority_by_segment")
def priority_by_segment(lake: Lake) -> DataFrame:
    return (v4_churn_detail(lake).groupBy("churn_priority", "segment")
            .agg(F.count(F.lit(1)).alias("customer_count"))
            .orderBy("churn_priority", "segment"))


@query("at_risk_by_state")
def at_risk_by_state(lake: Lake) -> DataFrame:
    return (at_risk(lake).groupBy("state")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 exact_sum("total_balance").alias("aum_at_risk"))
            .orderBy(F.col("aum_at_risk").desc()))


@query("csat_histogram")
def csat_histogram(lake: Lake, width: float = 0.5) -> DataFrame:
    v4 = v4_churn_detail(lake)
    return (v4.groupBy((F.floor(F.col("csat_score") / width) * width).alias("csat_bin"))
              .agg(F.count(F.lit(1)).alias("customer_count"))
              .orderBy("csat_bin"))


@query("inactivity_bins")
def inactivity_bins(lake: Lake) -> DataFrame:
    v4 = v4_churn_detail(lake)
    return (v4.groupBy(lower_bound_band("days_since_last_txn", D.INACTIVITY_BINS)
                       .alias("inactivity_bin"))
              .agg(F.count(F.lit(1)).alias("customer_count"))
              .orderBy("inactivity_bin"))


@query("spend_by_channel")
def spend_by_channel(lake: Lake) -> DataFrame:
    t = lake.silver_transactions.where(F.col("direction") == "Debit")
    return (t.groupBy("channel").agg(exact_sum("amount").alias("total_spend"),
                                     F.count(F.lit(1)).alias("txn_count"))
             .orderBy(F.col("total_spend").desc()))


@query("csat_matrix")
def csat_matrix(lake: Lake) -> DataFrame:
    """Priority × category matrix of average CSAT; the columns are the
    categories of the data (one more job finds them)."""
    return (lake.support_kpis.groupBy("priority")
            .pivot("category")
            .agg(F.round(exact_avg("avg_csat"), 2))
            .orderBy("priority"))


def _support_totals(lake: Lake) -> DataFrame:
    t = lake.silver_tickets
    n = F.count(F.lit(1))
    return t.agg(n.alias("total_tickets"),
                 F.round(F.avg("csat_score"), 2).alias("overall_csat"),
                 F.round(F.avg("resolution_days"), 1).alias("avg_days_to_resolve"),
                 F.round(F.sum(F.col("is_resolved").cast("int")) * 100.0 / n, 1)
                  .alias("resolution_rate_pct"),
                 F.round(F.sum(F.col("is_escalated").cast("int")) * 100.0 / n, 1)
                  .alias("escalation_rate_pct"))


@query("support_totals")
def support_totals(lake: Lake) -> DataFrame:
    """Ticket-weighted support KPIs (not an average of daily averages)."""
    return _support_totals(lake)


@query("kpi_status")
def kpi_status(lake: Lake) -> DataFrame:
    """Traffic-light status per headline KPI, one row per KPI."""
    def row(kpi, status):
        return F.struct(F.lit(kpi).alias("kpi"), F.col(kpi).cast("double").alias("value"), status.alias("status"))

    credit, churn = F.col("avg_credit_score"), F.col("churn_risk_pct")
    headline = v1_executive_kpis(lake).select(F.inline(F.array(     # the KPIs are computed once
        row("avg_credit_score", F.when(credit > D.CREDIT_CARD_GREEN, "Green")
            .when(credit > D.CREDIT_CARD_AMBER, "Amber").otherwise("Red")),
        row("churn_risk_pct", F.when(churn > D.CHURN_RED_PCT, "Red")
            .when(churn > D.CHURN_AMBER_PCT, "Amber").otherwise("Green")),
        row("portfolio_avg_csat", F.when(F.col("portfolio_avg_csat") >= D.CSAT_TARGET, "Green").otherwise("Red")))))
    days = F.col("avg_days_to_resolve")
    resolve = _support_totals(lake).select(F.inline(F.array(
        row("avg_days_to_resolve", F.when(days > D.RESOLUTION_RED_DAYS, "Red").otherwise("Green")))))
    return headline.unionByName(resolve)


@query("resolution_status")
def resolution_status(lake: Lake) -> DataFrame:
    """Days to resolve per category, slowest first, red above the threshold."""
    days = F.col("avg_resolution_days")
    return (q7_ticket_kpis(lake)
            .select("category", days, F.when(days > D.RESOLUTION_THRESHOLD_DAYS, "Red").otherwise("Green").alias("status"))
            .orderBy(days.desc(), "category"))


@query("kpi_labels")
def kpi_labels(lake: Lake) -> DataFrame:
    """Display labels: AUM in $…B and signed month-over-month percent."""
    v1 = v1_executive_kpis(lake)
    aum = v1.select(F.lit("aum").alias("label_name"), F.lit(None).cast("string").alias("period"),
                    F.concat(F.lit("$"), F.format_number("aum_billions", 1), F.lit("B"))
                     .alias("label"))
    v5 = v5_monthly_trend(lake).where(F.col("spend_mom_pct_change").isNotNull())
    pct = F.col("spend_mom_pct_change")
    mom = v5.select(F.lit("mom").alias("label_name"), "period",
                    F.concat(F.when(pct > 0, "+").otherwise(""),
                             F.format_number(pct, 1), F.lit("%")).alias("label"))
    return aum.unionByName(mom)


@query("tickets_rolling_30d")
def tickets_rolling_30d(lake: Lake, days: int = 30) -> DataFrame:
    """Daily ticket volume and its rolling 30-day sum.  The window is
    global but runs on one row per day."""
    daily = (lake.support_kpis.groupBy("created_date")
             .agg(F.sum("ticket_count").alias("ticket_count"))
             .withColumn("_day", F.datediff("created_date", F.lit(date(1970, 1, 1)))))
    w = Window.orderBy("_day").rangeBetween(-(days - 1), 0)
    return (daily.withColumn("rolling_30d_tickets", F.sum("ticket_count").over(w))
                 .drop("_day").orderBy("created_date"))


@query("flagged_vs_average")
def flagged_vs_average(lake: Lake) -> DataFrame:
    v5 = v5_monthly_trend(lake)
    return (v5.select("period", "txn_year", "txn_month", "flagged_txns",
                      (F.col("flagged_txns") > F.avg("flagged_txns").over(whole()))
                       .alias("above_average"))
              .orderBy("txn_year", "txn_month"))


@query("broadcast_lookup")
def broadcast_lookup(lake: Lake) -> DataFrame:
    """Tickets enriched with their branch (checked broadcast, left join)."""
    b = lake.silver_branches.select(F.col("branch_id").alias("b_id"), "branch_name",
                                    "branch_type", F.col("state").alias("branch_state"))
    t = lake.silver_tickets.select("ticket_id", "branch_id", "category")
    return lookup_join(t, b, "branch_id", "b_id").drop("b_id")


@query("branch_rollup")
def branch_rollup(lake: Lake) -> DataFrame:
    """Accounts per branch: aggregate the accounts first, then attach the
    branch attributes; codes without a branch row keep NULL attributes."""
    per_code = (lake.silver_accounts.groupBy("branch_code")
                .agg(F.count(F.lit(1)).alias("account_count"),
                     exact_sum("balance").alias("total_balance"),
                     F.count_if(F.col("account_status") == "Active").alias("active_accounts")))
    b = lake.silver_branches.select(
        "branch_id", "branch_name", "branch_type", F.col("state").alias("branch_state"))
    return (per_code.join(b, per_code.branch_code == b.branch_id, "left").drop("branch_id")
            .orderBy(F.col("total_balance").desc(), "branch_code"))
