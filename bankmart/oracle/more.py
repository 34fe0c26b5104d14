"""Oracle SQL: SCD2, Bronze/layer keys, bands and flags."""

from __future__ import annotations

from bankmart.oracle.base import AS_OF, CTES, RUN_TS, BATCH_ID
from bankmart.oracle.queries import add

#: the eight tracked attributes, in the order of their bits
TRACKED = ["segment", "credit_score", "annual_income", "kyc_status", "address_line1", "city", "state", "zip_code"]
_T = ", ".join(TRACKED)


def _differ(old: str, new: str) -> str:
    """Bits of the attributes that differ."""
    return "CAST(" + " + ".join(
        f"CASE WHEN {old}{c} IS DISTINCT FROM {new}{c} THEN {2 ** i} ELSE 0 END" for i, c in enumerate(TRACKED)) + " AS BIGINT)"


CTES["yearly_batches"] = f"""
SELECT customer_id, make_date(y + 1, 1, 1) AS batch_date, {_T}
FROM (SELECT *, year(effective_date) AS y,
        row_number() OVER (PARTITION BY customer_id, year(effective_date)
                           ORDER BY effective_date DESC, seq DESC) AS r
      FROM change_log) WHERE r = 1"""

CTES["states_all"] = f"""
SELECT customer_id, {_T} FROM change_log
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY effective_date DESC, seq DESC) = 1"""
CTES["states_cut"] = f"""
SELECT customer_id, {_T} FROM change_log WHERE effective_date <= DATE '1998-06-30'
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY effective_date DESC, seq DESC) = 1"""


def _versions(states: str, start: str) -> str:
    """SCD2 versions of one state per customer and day."""
    lags = ", ".join(f"lag({c}) OVER k AS old_{c}" for c in TRACKED)
    return f"""
SELECT customer_id, {_T}, scd_start_date, lead(scd_start_date) OVER w AS scd_end_date,
  (lead(scd_start_date) OVER w) IS NULL AS scd_is_current,
  CAST(row_number() OVER w AS INTEGER) AS scd_version,
  CASE WHEN rn = 1 THEN 0 ELSE scd_changed END AS scd_changed
FROM (SELECT *, {_differ("old_", "")} AS scd_changed
      FROM (SELECT customer_id, {_T}, {start} AS scd_start_date, {lags}, row_number() OVER k AS rn
            FROM {states} WINDOW k AS (PARTITION BY customer_id ORDER BY {start})) a) b
WHERE rn = 1 OR scd_changed > 0
WINDOW w AS (PARTITION BY customer_id ORDER BY scd_start_date)"""


CTES["daily_states"] = f"""
SELECT customer_id, effective_date, {_T} FROM change_log
QUALIFY row_number() OVER (PARTITION BY customer_id, effective_date ORDER BY seq DESC) = 1"""
CTES["attribute_history"] = _versions("daily_states", "effective_date")
YEARLY_VERSIONS = _versions("yearly_batches", "batch_date")

CTES["multi_batch_bronze"] = f"""
SELECT customer_id, {_T}, 'CRM' AS _source_system, 'customers.csv' AS _source_file,
  strftime(batch_date, '%Y%m%d') || '_000000' AS _batch_id,
  CAST(batch_date AS TIMESTAMP) AS _ingest_ts, strftime(batch_date, '%Y-%m-%d') AS _batch_date,
  TRUE AS _is_current
FROM yearly_batches"""

add("scd2_history", "SELECT * FROM attribute_history")
add("scd2_current", "SELECT * FROM attribute_history WHERE scd_is_current")
add("scd2_as_of", """
SELECT * FROM attribute_history
WHERE scd_start_date <= DATE '1998-06-30'
  AND (scd_end_date IS NULL OR DATE '1998-06-30' < scd_end_date)""")
add("scd2_counts", """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE scd_is_current) AS current_rows
FROM attribute_history""")
add("scd2_apply", YEARLY_VERSIONS)
add("scd2_initial", f"""
SELECT *, {AS_OF} AS scd_start_date, CAST(NULL AS DATE) AS scd_end_date,
  TRUE AS scd_is_current, 1 AS scd_version FROM states_all""")
add("scd2_new_keys", """
SELECT * FROM states_all n
WHERE NOT EXISTS (SELECT 1 FROM states_cut o WHERE o.customer_id = n.customer_id)""")
add("scd2_changed_keys", f"""
SELECT * FROM (
  SELECT n.*, 1 AS previous_version, {_differ("o.", "n.")} AS changed_columns
  FROM states_all n JOIN states_cut o ON o.customer_id = n.customer_id)
WHERE changed_columns > 0""")
_ASKED = [("_batch_id <= '19990101_000000'", "19990101_000000")] + [
    (f"_ingest_ts <= TIMESTAMP '{t}'", t) for t in
    ("1990-01-01 00:00:00", "1997-01-01 00:00:00", "1998-12-31 23:59:59", "2030-06-01 12:00:00")]
add("snapshot_as_of", " UNION ALL ".join(f"""
SELECT *, '{label}' AS asked FROM multi_batch_bronze WHERE {condition}
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingest_ts DESC, _batch_id DESC) = 1"""
                                         for condition, label in _ASKED))
add("batch_ledger", """
SELECT _batch_id, COUNT(*) AS row_count, MIN(_ingest_ts) AS first_ingest_ts,
  MAX(_ingest_ts) AS last_ingest_ts, MAX(_batch_date) AS batch_date
FROM multi_batch_bronze GROUP BY _batch_id ORDER BY _batch_id DESC LIMIT 5""")
add("bronze_stamp", "SELECT * FROM bronze_customers")
add("table_scan", "SELECT * FROM ext_transactions")
add("dedup_latest", """
SELECT transaction_id, transaction_date, reference_number, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
      ORDER BY _ingest_ts DESC, _batch_id DESC, transaction_date DESC NULLS LAST,
               reference_number, amount, balance_after, fraud_score, transaction_time) AS r
  FROM bronze_transactions) WHERE r = 1""")
add("schema_evolve", f"""
SELECT * REPLACE (CAST(credit_score AS BIGINT) AS credit_score), 'CRM' AS _source_system,
  'customers.csv' AS _source_file, '20011103_000000' AS _batch_id,
  {RUN_TS} AS _ingest_ts, '2001-11-03' AS _batch_date, TRUE AS _is_current,
  CAST(NULL AS VARCHAR) AS loyalty_tier
FROM ext_customers WHERE CAST(customer_id AS BIGINT) % 2 = 0
UNION ALL
SELECT * REPLACE (CAST(credit_score AS BIGINT) AS credit_score), 'CRM', 'customers.csv', '{BATCH_ID}',
  {RUN_TS}, '2001-11-04', TRUE, CASE WHEN credit_score >= 740 THEN 'Gold' ELSE 'Standard' END
FROM ext_customers WHERE NOT (CAST(customer_id AS BIGINT) % 2 = 0)""")

_LAYERS = [("bronze", "customers", "bronze_customers"), ("bronze", "accounts", "bronze_accounts"),
           ("bronze", "transactions", "bronze_transactions"),
           ("bronze", "branches", "bronze_branches"),
           ("bronze", "support_tickets", "bronze_tickets")]
_LAYERS += [("silver", n, n) for n in ["silver_customers", "silver_accounts",
                                       "silver_transactions", "silver_branches",
                                       "silver_tickets"]]
_LAYERS += [("gold", n, n) for n in ["customer_360", "txn_monthly_summary",
                                     "segment_metrics", "support_kpis"]]
_counts = "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {cte}"
    for layer, name, cte in _LAYERS)
add("layer_audit", f"""
SELECT COALESCE(layer, 'ALL') AS layer,
  CASE WHEN GROUPING(layer, table_name) > 0 THEN 'TOTAL' ELSE table_name END AS table_name,
  CAST(SUM(row_count) AS BIGINT) AS row_count
FROM ({_counts}) c GROUP BY ROLLUP (layer, table_name)""")
add("pk_check", """
SELECT 'customer_360' AS table_name, 'customer_id' AS key_column, COUNT(*) AS row_count,
  COUNT(DISTINCT customer_id) AS distinct_keys, COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_keys,
  COUNT(*) = COUNT(DISTINCT customer_id) AND COUNT(*) FILTER (WHERE customer_id IS NULL) = 0 AS is_unique
FROM customer_360
UNION ALL
SELECT 'segment_metrics', 'segment', COUNT(*), COUNT(DISTINCT segment),
  COUNT(*) FILTER (WHERE segment IS NULL),
  COUNT(*) = COUNT(DISTINCT segment) AND COUNT(*) FILTER (WHERE segment IS NULL) = 0
FROM segment_metrics""")
add("c360_sample", """
SELECT first_name, last_name, segment, total_balance, credit_score, total_transactions,
  churn_risk_flag, high_value_flag
FROM customer_360 ORDER BY customer_id LIMIT 3""")
add("partition_values", """
SELECT DISTINCT txn_year, txn_month FROM silver_transactions ORDER BY txn_year, txn_month""")
add("partition_pruned_count", """
SELECT COUNT(*) AS row_count FROM silver_transactions WHERE txn_year = 1998 AND txn_month = 3""")
add("band_age", "SELECT customer_id, age, age_band FROM silver_customers")
add("band_income", "SELECT customer_id, annual_income, income_tier FROM silver_customers")
add("band_credit", "SELECT customer_id, credit_score, credit_band FROM silver_customers")
add("churn_flag", """
SELECT customer_id, days_since_last_txn, avg_csat_score, escalated_tickets, churn_risk_flag
FROM customer_360""")
add("high_value_flag", "SELECT customer_id, total_balance, segment, high_value_flag FROM customer_360")
