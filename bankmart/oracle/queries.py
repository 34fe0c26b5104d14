"""Oracle SQL per registered key (DuckDB dialect over the test tables)."""

from __future__ import annotations

from bankmart import domains as D
from bankmart.config import DEFAULT
from bankmart.oracle.base import CTES, with_ctes, xsum, xavg, RUN_TS

CTES["change_log"] = """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE WHEN k % 11 <> 0 THEN o_orderpriority END AS segment,
  CASE WHEN k % 13 <> 0 THEN CAST(600 + k % 3 * 50 AS INTEGER) END AS credit_score,
  CASE WHEN k % 17 <> 0 THEN CAST(40000 + k // 4 % 2 * 25000 AS DOUBLE) END AS annual_income,
  CASE WHEN k % 19 <> 0 THEN ['Verified', 'Pending', 'Failed'][CAST(k // 5 % 3 AS BIGINT) + 1] END AS kyc_status,
  CASE WHEN k % 23 <> 0 THEN CAST(k % 2 + 1 AS VARCHAR) || ' Main St' END AS address_line1,
  CASE WHEN k % 29 <> 0 THEN 'City_' || CAST(k // 8 % 3 AS VARCHAR) END AS city,
  CASE WHEN k % 31 <> 0 THEN 'A' || chr(CAST(65 + k // 16 % 2 AS INTEGER)) END AS state,
  CASE WHEN k % 37 <> 0 THEN lpad(CAST(k // 32 % 2 * 31 AS VARCHAR), 5, '0') END AS zip_code,
  CAST(o_orderdate AS DATE) AS effective_date, k AS seq
FROM (SELECT *, o_orderkey AS k FROM orders) o"""

CTES["segment_log"] = """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS segment,
  CAST(o_orderdate AS DATE) AS effective_date, o_orderkey AS seq FROM orders"""

CTES["segment_history"] = """
SELECT customer_id, segment, scd_start_date,
  lead(scd_start_date) OVER w AS scd_end_date,
  (lead(scd_start_date) OVER w) IS NULL AS scd_is_current,
  CAST(row_number() OVER w AS INTEGER) AS scd_version
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY scd_start_date) AS rn,
        lag(segment) OVER (PARTITION BY customer_id ORDER BY scd_start_date) AS prev
      FROM (SELECT customer_id, segment, effective_date AS scd_start_date
            FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, effective_date
                                               ORDER BY seq DESC) AS r
                  FROM segment_log) WHERE r = 1) daily) d
WHERE rn = 1 OR prev IS DISTINCT FROM segment
WINDOW w AS (PARTITION BY customer_id ORDER BY scd_start_date)"""

NAME = "first_name || ' ' || last_name AS customer_name"
FLAGN = "CAST(SUM(CASE WHEN {0} THEN 1 ELSE 0 END) AS BIGINT)"


def flagn(c):
    return FLAGN.format(c)


def monthly(digits: int, flagged: str) -> str:
    return f"""
SELECT period, txn_year, txn_month,
  CAST(SUM(txn_count) AS BIGINT) AS total_transactions,
  round({xsum("total_debit")} / 1e6, {digits}) AS total_spend_millions,
  round({xsum("total_credit")} / 1e6, {digits}) AS total_deposits_millions,
  round({xsum("net_flow")} / 1e6, {digits}) AS net_flow_millions,
  COUNT(DISTINCT customer_id) AS active_customers,
  round({xavg("avg_txn_amount")}, 2) AS avg_txn_size,
  CAST(SUM(flagged_count) AS BIGINT) AS {flagged},
  {xsum("total_debit")} AS spend
FROM txn_monthly_summary GROUP BY period, txn_year, txn_month"""


_FINAL: dict[str, str] = {
    "account_kpis": "SELECT * FROM account_kpis",
    "txn_kpis": "SELECT * FROM txn_kpis",
    "ticket_kpis": "SELECT * FROM ticket_kpis",
    "customer_360": "SELECT * FROM customer_360",
    "txn_monthly_summary": "SELECT * FROM txn_monthly_summary",
    "segment_metrics": "SELECT * FROM segment_metrics",
    "support_kpis": "SELECT * FROM support_kpis",
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_accounts": "SELECT * FROM silver_accounts",
    "silver_transactions": "SELECT * FROM silver_transactions",
    "silver_branches": "SELECT * FROM silver_branches",
    "silver_tickets": "SELECT * FROM silver_tickets",

    "q1_segment_summary": f"""
SELECT segment, customer_count,
  round(customer_count * 100.0::DOUBLE / SUM(customer_count) OVER (), 1) AS pct_of_total,
  avg_balance, avg_credit_score, aum_millions, avg_tenure_yrs, avg_products_held
FROM (SELECT segment, COUNT(*) AS customer_count, round({xavg("total_balance")}, 0) AS avg_balance,
        round(AVG(credit_score), 0) AS avg_credit_score,
        round({xsum("total_balance")} / 1e6, 2) AS aum_millions,
        round({xavg("tenure_years")}, 1) AS avg_tenure_yrs,
        round(AVG(product_diversity_count), 1) AS avg_products_held
      FROM customer_360 GROUP BY segment) s
ORDER BY aum_millions DESC""",

    "q2_churn_top100": f"""
SELECT customer_id, {NAME}, segment, credit_band, round(total_balance, 0) AS total_balance,
  days_since_last_txn, round(avg_csat_score, 1) AS csat, escalated_tickets, total_tickets,
  CASE WHEN days_since_last_txn > 180 THEN 'Critical' WHEN days_since_last_txn > 90 THEN 'High'
       WHEN avg_csat_score < 2.5 THEN 'High' ELSE 'Medium' END AS churn_priority
FROM customer_360 WHERE churn_risk_flag = TRUE
ORDER BY round(total_balance, 0) DESC, days_since_last_txn DESC NULLS LAST, customer_id
LIMIT 100""",

    "q3_high_value": f"""
SELECT customer_id, {NAME}, segment, age_band, income_tier, state,
  round(total_balance, 0) AS total_balance, active_account_count, product_diversity_count,
  round(total_spend_12m, 0) AS spend_12m, round(net_cash_flow_12m, 0) AS net_cash_flow,
  preferred_channel, round(avg_csat_score, 2) AS csat_score, tenure_years
FROM customer_360 WHERE high_value_flag = TRUE AND kyc_status = 'Verified'
ORDER BY round(total_balance, 0) DESC, customer_id LIMIT 50""",

    "q4_monthly_trend": f"""
SELECT * EXCLUDE (spend) FROM ({monthly(2, "flagged_transactions")}) m
ORDER BY txn_year, txn_month""",

    "q5_geography": f"""
SELECT state, COUNT(*) AS customer_count, round({xsum("total_balance")} / 1e6, 2) AS aum_millions,
  round(AVG(credit_score), 0) AS avg_credit_score,
  {flagn("churn_risk_flag")} AS churn_risk_count, {flagn("high_value_flag")} AS high_value_count
FROM customer_360 GROUP BY state ORDER BY aum_millions DESC""",

    "q6_cross_sell": f"""
SELECT customer_id, {NAME}, segment, round(total_balance, 0) AS total_balance,
  round(annual_income, 0) AS annual_income, income_tier, product_diversity_count,
  credit_score, tenure_years
FROM customer_360
WHERE segment IN ('Retail', 'Premier') AND list_contains(product_types_held, 'Checking')
  AND NOT list_contains(product_types_held, 'Investment') AND kyc_status = 'Verified'
  AND annual_income > 75000 AND churn_risk_flag = FALSE
ORDER BY round(total_balance, 0) DESC, customer_id LIMIT 200""",

    "q7_ticket_kpis": f"""
SELECT category, COUNT(*) AS total_tickets, round({xavg("avg_resolution_days")}, 1) AS avg_resolution_days,
  round({xavg("avg_csat")}, 2) AS avg_csat, round({xavg("resolution_rate")}, 1) AS resolution_rate_pct,
  round({xavg("escalation_rate")}, 1) AS escalation_rate_pct,
  CAST(SUM(ticket_count) AS BIGINT) AS total_volume
FROM support_kpis GROUP BY category ORDER BY avg_resolution_days DESC""",

    "q8_segment_changes": f"""
SELECT customer_id, segment AS new_segment, scd_start_date, scd_end_date, scd_version, scd_is_current
FROM segment_history
WHERE scd_version > 1
  AND scd_start_date >= DATE '{DEFAULT.changes_as_of.isoformat()}' - INTERVAL 12 MONTH
ORDER BY customer_id, scd_version""",

    "q9_fraud_exposure": f"""
SELECT segment, COUNT(DISTINCT customer_id) AS customers_with_flags,
  CAST(SUM(flagged_txn_count) AS BIGINT) AS total_flagged_txns,
  round({xavg("avg_fraud_score")}, 4) AS avg_fraud_score,
  round({xsum("total_spend_12m")}, 0) AS total_spend,
  round(SUM(flagged_txn_count) * 100.0::DOUBLE / NULLIF(SUM(total_transactions), 0), 2) AS flagged_txn_pct
FROM customer_360 WHERE flagged_txn_count > 0
GROUP BY segment ORDER BY total_flagged_txns DESC""",

    "v1_executive_kpis": f"""
SELECT COUNT(*) AS total_customers, round({xsum("total_balance")} / 1e9, 3) AS aum_billions,
  round(AVG(credit_score), 0) AS avg_credit_score,
  round({xavg("tenure_years")}, 1) AS avg_tenure_years,
  {flagn("high_value_flag")} AS high_value_customers,
  {flagn("churn_risk_flag")} AS churn_risk_customers,
  round(AVG(product_diversity_count), 2) AS avg_products_per_customer,
  round({xsum("total_spend_12m")} / 1e6, 2) AS total_spend_12m_millions,
  round({xavg("avg_csat_score")}, 2) AS portfolio_avg_csat,
  round(SUM(CASE WHEN churn_risk_flag THEN 1 ELSE 0 END) * 100.0::DOUBLE / COUNT(*), 1) AS churn_risk_pct,
  {RUN_TS} AS refreshed_at
FROM customer_360 WHERE kyc_status = 'Verified'""",

    "v2_segment_breakdown": """
SELECT segment, customer_count,
  round(customer_count * 100.0::DOUBLE / SUM(customer_count) OVER (), 1) AS pct_of_customers,
  round(aum_total / 1e6, 2) AS aum_millions,
  round(aum_total * 100.0::DOUBLE / SUM(aum_total) OVER (), 1) AS pct_of_aum,
  round(avg_total_balance, 0) AS avg_balance, round(avg_credit_score, 0) AS avg_credit_score,
  round(avg_products_held, 2) AS avg_products, round(avg_spend_12m, 0) AS avg_spend_12m,
  churn_risk_pct, high_value_pct, round(avg_csat, 2) AS avg_csat,
  round(avg_tenure_years, 1) AS avg_tenure_yrs
FROM segment_metrics ORDER BY aum_total DESC""",

    "v3_geography": f"""
SELECT state, COUNT(*) AS customer_count, round({xsum("total_balance")} / 1e6, 2) AS aum_millions,
  round(AVG(credit_score), 0) AS avg_credit_score, round({xavg("annual_income")}, 0) AS avg_income,
  {flagn("churn_risk_flag")} AS churn_risk_count, {flagn("high_value_flag")} AS high_value_count,
  round(AVG(product_diversity_count), 2) AS avg_products, round({xavg("avg_csat_score")}, 2) AS avg_csat
FROM customer_360 GROUP BY state ORDER BY aum_millions DESC""",

    "v4_churn_detail": f"""
SELECT customer_id, {NAME}, email, segment, age_band, income_tier, state,
  round(total_balance, 0) AS total_balance, round(total_spend_12m, 0) AS spend_12m,
  days_since_last_txn, round(avg_csat_score, 1) AS csat_score, escalated_tickets, total_tickets,
  preferred_channel,
  CASE WHEN days_since_last_txn > 180 AND total_balance > 50000 THEN '{D.PRIORITY_DETAILED[0]}'
       WHEN days_since_last_txn > 180 THEN '{D.PRIORITY_DETAILED[1]}'
       WHEN avg_csat_score < 2.5 AND escalated_tickets > 0 THEN '{D.PRIORITY_DETAILED[2]}'
       WHEN avg_csat_score < 2.5 THEN '{D.PRIORITY_DETAILED[3]}'
       WHEN escalated_tickets > 1 THEN '{D.PRIORITY_DETAILED[4]}'
       ELSE '{D.PRIORITY_DETAILED[5]}' END AS churn_priority,
  CASE WHEN preferred_channel = 'Mobile' THEN '{D.CHANNEL_ACTIONS[0][1]}'
       WHEN preferred_channel = 'Branch' THEN '{D.CHANNEL_ACTIONS[1][1]}'
       WHEN preferred_channel = 'Phone' THEN '{D.CHANNEL_ACTIONS[2][1]}'
       ELSE '{D.DEFAULT_ACTION}' END AS recommended_action
FROM customer_360 WHERE churn_risk_flag = TRUE AND kyc_status = 'Verified'
ORDER BY round(total_balance, 0) DESC""",

    "v5_monthly_trend": f"""
SELECT * EXCLUDE (spend),
  lag(spend, 1) OVER (ORDER BY txn_year, txn_month) AS prev_month_spend,
  round((spend - lag(spend, 1) OVER (ORDER BY txn_year, txn_month)) * 100.0::DOUBLE
        / NULLIF(lag(spend, 1) OVER (ORDER BY txn_year, txn_month), 0), 1) AS spend_mom_pct_change
FROM ({monthly(3, "flagged_txns")}) m ORDER BY txn_year, txn_month""",

    "v6_cross_sell": f"""
SELECT * FROM (
  SELECT customer_id, {NAME}, segment, income_tier, credit_band,
    round(total_balance, 0) AS total_balance, round(annual_income, 0) AS annual_income,
    product_diversity_count, product_types_held, preferred_channel, tenure_years,
    CASE WHEN NOT list_contains(product_types_held, 'Investment') THEN TRUE ELSE FALSE END
      AS investment_opportunity,
    CASE WHEN NOT list_contains(product_types_held, 'Mortgage') AND annual_income > 60000
      THEN TRUE ELSE FALSE END AS mortgage_opportunity,
    CASE WHEN NOT list_contains(product_types_held, 'Credit Card') AND credit_score > 680
      THEN TRUE ELSE FALSE END AS credit_card_opportunity
  FROM customer_360
  WHERE kyc_status = 'Verified' AND churn_risk_flag = FALSE
    AND segment IN ('Retail', 'Premier', 'Private')) v
WHERE investment_opportunity OR mortgage_opportunity OR credit_card_opportunity
ORDER BY total_balance DESC""",

    "v7_support_ops": f"""
SELECT category, priority, CAST(SUM(ticket_count) AS BIGINT) AS total_tickets,
  round({xavg("avg_resolution_days")}, 1) AS avg_days_to_resolve,
  round({xavg("avg_csat")}, 2) AS avg_csat_score,
  round({xavg("resolution_rate")}, 1) AS resolution_rate_pct,
  round({xavg("escalation_rate")}, 1) AS escalation_rate_pct,
  CAST(SUM(escalation_count) AS BIGINT) AS total_escalations,
  CAST(SUM(distinct_customers) AS BIGINT) AS customers_affected
FROM support_kpis GROUP BY category, priority ORDER BY avg_days_to_resolve DESC, category""",

    "sanity_union": f"""
SELECT 'customer_360' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT segment) AS distinct_segments,
  round({xsum("total_balance")} / 1e6, 2) AS aum_millions FROM customer_360
UNION ALL
SELECT 'txn_monthly_summary', COUNT(*), COUNT(DISTINCT period), CAST(NULL AS DOUBLE) FROM txn_monthly_summary
UNION ALL
SELECT 'segment_metrics', COUNT(*), COUNT(DISTINCT segment), round({xsum("aum_total")} / 1e6, 2)
FROM segment_metrics""",
}

# keys whose result has the product_types_held array: compared in display
# form (comma-joined text), like the Spark side's catalogue output
ARRAY_KEYS = {"account_kpis", "customer_360", "v6_cross_sell", "clustered_rewrite",
              "serving_load"}


def _display(key: str, sql: str) -> str:
    if key not in ARRAY_KEYS:
        return sql
    return ("SELECT * REPLACE (array_to_string(product_types_held, ',') AS product_types_held) "
            f"FROM ({sql}) display")


ORACLE: dict[str, str] = {k: with_ctes(_display(k, v)) for k, v in _FINAL.items()}


def add(key: str, sql: str) -> None:
    ORACLE[key] = with_ctes(_display(key, sql))


from bankmart.oracle import dq as _dq  # noqa: E402,F401  (registers DQ oracles)
from bankmart.oracle import more as _more  # noqa: E402,F401
from bankmart.oracle import dashboard as _dashboard  # noqa: E402,F401
from bankmart.oracle import jobs as _jobs  # noqa: E402,F401
