"""Oracle SQL for the dashboard queries and lookup joins."""

from __future__ import annotations

from bankmart import domains as D
from bankmart.oracle.base import CTES, xsum, xavg
from bankmart.oracle.queries import add, _FINAL

CTES["v1"] = _FINAL["v1_executive_kpis"]
CTES["v4"] = _FINAL["v4_churn_detail"]
CTES["v5"] = _FINAL["v5_monthly_trend"]
CTES["at_risk"] = "SELECT * FROM customer_360 WHERE churn_risk_flag = TRUE AND kyc_status = 'Verified'"
CTES["support_totals"] = """
SELECT COUNT(*) AS total_tickets, round(AVG(csat_score), 2) AS overall_csat,
  round(AVG(resolution_days), 1) AS avg_days_to_resolve,
  round(SUM(CAST(is_resolved AS INTEGER)) * 100.0::DOUBLE / COUNT(*), 1) AS resolution_rate_pct,
  round(SUM(CAST(is_escalated AS INTEGER)) * 100.0::DOUBLE / COUNT(*), 1) AS escalation_rate_pct
FROM silver_tickets"""

add("trend_last_12", """
SELECT period, txn_year, txn_month, total_spend_millions FROM (
  SELECT * FROM v5 ORDER BY txn_year DESC, txn_month DESC LIMIT 12) t
ORDER BY txn_year, txn_month""")
add("sliced_kpis", f"""
SELECT segment, balance_tier, COUNT(*) AS customer_count,
  round({xsum("total_balance")} / 1e6, 2) AS aum_millions, round(AVG(credit_score), 0) AS avg_credit_score,
  CAST(SUM(CASE WHEN churn_risk_flag THEN 1 ELSE 0 END) AS BIGINT) AS churn_risk_count
FROM (SELECT *, CASE WHEN total_balance < 10000 THEN '<10k' WHEN total_balance < 100000 THEN '10k-100k'
                     ELSE '100k+' END AS balance_tier FROM customer_360) c
WHERE segment IN ('Retail', 'Premier')
  AND last_transaction_date BETWEEN DATE '2000-01-01' AND DATE '2001-12-31'
  AND balance_tier IN ('10k-100k', '100k+')
GROUP BY segment, balance_tier ORDER BY segment, balance_tier""")
add("customer_profile", f"""
SELECT customer_id, first_name || ' ' || last_name AS customer_name, segment, age_band, state,
  kyc_status, preferred_channel, total_balance, total_spend_12m AS spend_12m, credit_score,
  CASE WHEN credit_score >= {D.CREDIT_COLOR_GREEN} THEN 'Green'
       WHEN credit_score >= {D.CREDIT_COLOR_AMBER} THEN 'Amber' ELSE 'Red' END AS credit_color,
  array_to_string(product_types_held, ', ') AS products_held
FROM customer_360 WHERE first_name || ' ' || last_name = 'Customer 000000007'""")
add("customer_monthly", """
SELECT customer_id, period, total_debit FROM txn_monthly_summary WHERE customer_id = '7'
ORDER BY period""")
add("churn_indicators", """
SELECT customer_id, days_since_last_txn, avg_csat_score, escalated_tickets,
  days_since_last_txn > 90 AS inactive_trigger, avg_csat_score < 3.0 AS csat_trigger,
  escalated_tickets > 1 AS escalation_trigger, churn_risk_flag
FROM customer_360""")
add("customer_tickets", """
SELECT t.customer_id, c.first_name || ' ' || c.last_name AS customer_name, t.ticket_id, t.category,
  t.status, t.created_date, t.csat_score, t.resolution_days
FROM silver_tickets t LEFT JOIN customer_360 c ON t.customer_id = c.customer_id
WHERE t.customer_id = '7' ORDER BY t.created_date DESC, t.ticket_id""")
add("at_risk_totals", f"""
SELECT COUNT(*) AS at_risk_customers, {xsum("total_balance")} AS aum_at_risk FROM at_risk""")
add("priority_by_segment", """
SELECT churn_priority, segment, COUNT(*) AS customer_count FROM v4
GROUP BY churn_priority, segment ORDER BY churn_priority, segment""")
add("at_risk_by_state", f"""
SELECT state, COUNT(*) AS customer_count, {xsum("total_balance")} AS aum_at_risk FROM at_risk
GROUP BY state ORDER BY aum_at_risk DESC""")
add("csat_histogram", """
SELECT floor(csat_score / 0.5) * 0.5 AS csat_bin, COUNT(*) AS customer_count FROM v4
GROUP BY csat_bin ORDER BY csat_bin""")
add("inactivity_bins", """
SELECT CASE WHEN days_since_last_txn IS NULL THEN NULL WHEN days_since_last_txn < 30 THEN '0-30'
            WHEN days_since_last_txn < 90 THEN '30-90' WHEN days_since_last_txn < 180 THEN '90-180'
            ELSE '180+' END AS inactivity_bin, COUNT(*) AS customer_count
FROM v4 GROUP BY inactivity_bin ORDER BY inactivity_bin""")
add("spend_by_channel", f"""
SELECT channel, {xsum("amount")} AS total_spend, COUNT(*) AS txn_count
FROM silver_transactions WHERE direction = 'Debit' GROUP BY channel ORDER BY total_spend DESC""")
_cats = ["click", "error", "purchase", "signup", "view"]
add("csat_matrix", "SELECT priority, " + ", ".join(
    f"round({xavg(f'CASE WHEN category = {chr(39)}{c}{chr(39)} THEN avg_csat END')}, 2) AS \"{c}\"" for c in _cats)
    + " FROM support_kpis GROUP BY priority ORDER BY priority")
add("support_totals", "SELECT * FROM support_totals")
add("kpi_status", f"""
SELECT 'avg_credit_score' AS kpi, avg_credit_score AS value,
  CASE WHEN avg_credit_score > {D.CREDIT_CARD_GREEN} THEN 'Green'
       WHEN avg_credit_score > {D.CREDIT_CARD_AMBER} THEN 'Amber' ELSE 'Red' END AS status FROM v1
UNION ALL
SELECT 'churn_risk_pct', churn_risk_pct,
  CASE WHEN churn_risk_pct > {D.CHURN_RED_PCT} THEN 'Red'
       WHEN churn_risk_pct > {D.CHURN_AMBER_PCT} THEN 'Amber' ELSE 'Green' END FROM v1
UNION ALL
SELECT 'portfolio_avg_csat', portfolio_avg_csat,
  CASE WHEN portfolio_avg_csat >= {D.CSAT_TARGET} THEN 'Green' ELSE 'Red' END FROM v1
UNION ALL
SELECT 'avg_days_to_resolve', avg_days_to_resolve,
  CASE WHEN avg_days_to_resolve > {D.RESOLUTION_RED_DAYS} THEN 'Red' ELSE 'Green' END
FROM support_totals""")
add("tickets_rolling_30d", """
SELECT created_date, ticket_count,
  CAST(SUM(ticket_count) OVER (ORDER BY created_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING
                                AND CURRENT ROW) AS BIGINT) AS rolling_30d_tickets
FROM (SELECT created_date, CAST(SUM(ticket_count) AS BIGINT) AS ticket_count
      FROM support_kpis GROUP BY created_date) d ORDER BY created_date""")
add("flagged_vs_average", """
SELECT period, txn_year, txn_month, flagged_txns, flagged_txns > AVG(flagged_txns) OVER () AS above_average
FROM v5 ORDER BY txn_year, txn_month""")
add("broadcast_lookup", """
SELECT t.ticket_id, t.branch_id, t.category, b.branch_name, b.branch_type, b.state AS branch_state
FROM silver_tickets t LEFT JOIN silver_branches b ON t.branch_id = b.branch_id""")
add("branch_rollup", f"""
SELECT a.branch_code, a.account_count, a.total_balance, a.active_accounts,
  b.branch_name, b.branch_type, b.state AS branch_state
FROM (SELECT branch_code, COUNT(*) AS account_count, {xsum("balance")} AS total_balance,
        COUNT(*) FILTER (WHERE account_status = 'Active') AS active_accounts
      FROM silver_accounts GROUP BY branch_code) a
LEFT JOIN silver_branches b ON a.branch_code = b.branch_id
ORDER BY a.total_balance DESC, a.branch_code""")
add("resolution_status", f"""
SELECT category, avg_resolution_days, CASE WHEN avg_resolution_days > 7 THEN 'Red' ELSE 'Green' END AS status
FROM (SELECT category, round({xavg("avg_resolution_days")}, 1) AS avg_resolution_days FROM support_kpis GROUP BY category) c
ORDER BY avg_resolution_days DESC, category""")
add("kpi_labels", """
SELECT 'aum' AS label_name, CAST(NULL AS VARCHAR) AS period, '$' || format('{:,.1f}', aum_billions) || 'B' AS label FROM v1
UNION ALL
SELECT 'mom', period, CASE WHEN spend_mom_pct_change > 0 THEN '+' ELSE '' END
  || format('{:,.1f}', spend_mom_pct_change) || '%' FROM v5 WHERE spend_mom_pct_change IS NOT NULL""")
