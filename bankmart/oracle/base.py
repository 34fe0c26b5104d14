"""Shared CTEs for the DuckDB oracle: adapters → Bronze → Silver → Gold.

Written independently of the Spark code as plain SQL over the
pre-registered test tables.  ``with_ctes(sql)`` prefixes a query with the
CTEs it (transitively) needs.
"""

from __future__ import annotations

import re

from bankmart import domains as D
from bankmart.config import DEFAULT

AS_OF = f"DATE '{DEFAULT.as_of.isoformat()}'"
RUN_TS = f"TIMESTAMP '{DEFAULT.run_ts_text}'"
BATCH_ID = DEFAULT.batch_id


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values, idx: str) -> str:
    return f"({lst(values)})[CAST({idx} AS BIGINT) + 1]"


def inlist(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


def xsum(expr: str) -> str:
    """Order-independent sum of doubles (fixed-point at 1e-9)."""
    return f"CAST(SUM(CAST(({expr}) AS DECIMAL(28,9))) AS DOUBLE)"


def xavg(expr: str) -> str:
    return f"({xsum(expr)} / CAST(COUNT({expr}) AS DOUBLE))"


def band(col: str, table) -> str:
    arms = []
    for upper, label in table:
        if upper is None:
            arms.append(f"ELSE '{label}'")
        else:
            arms.append(f"WHEN {col} < {upper} THEN '{label}'")
    return "CASE " + " ".join(arms) + " END"


def day_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def state_code(nk: str) -> str:
    return f"(chr(CAST(65 + {nk} // 5 AS INTEGER)) || chr(CAST(65 + {nk} % 5 AS INTEGER)))"


def to_date(col: str) -> str:
    return f"CAST(TRY_STRPTIME({col}, '%Y-%m-%d') AS DATE)"


def ddiff(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


SEG_CASE = ("CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Retail' WHEN 'BUILDING' THEN 'Premier' "
            "WHEN 'FURNITURE' THEN 'Private' WHEN 'HOUSEHOLD' THEN 'SMB' "
            "WHEN 'MACHINERY' THEN 'Corporate' END")

CTES: dict[str, str] = {}

CTES["ext_customers"] = f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
  split_part(c.c_name, '#', 1) AS first_name,
  split_part(c.c_name, '#', 2) AS last_name,
  '  ' || c.c_name || '@Example.COM ' AS email,
  '555-' || lpad(CAST(c.c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
  {day_text("DATE '1925-01-01' + CAST((c.c_custkey * 101) % 21184 AS INTEGER)")} AS date_of_birth,
  lpad(CAST((c.c_custkey * 7) % 10000 AS VARCHAR), 4, '0') AS ssn_last4,
  CAST(c.c_custkey % 997 + 1 AS VARCHAR) || ' Main St' AS address_line1,
  'City_' || CAST(c.c_nationkey AS VARCHAR) AS city,
  {state_code("n.n_nationkey")} AS state,
  lpad(CAST((c.c_custkey * 31) % 100000 AS VARCHAR), 5, '0') AS zip_code,
  'US' AS country,
  {SEG_CASE} AS segment,
  CAST(580 + (c.c_custkey * 37) % 271 AS INTEGER) AS credit_score,
  CAST(30000 + (c.c_custkey * 7919) % 470001 AS DOUBLE) AS annual_income,
  CASE WHEN c.c_custkey % 100 < 88 THEN 'Verified' WHEN c.c_custkey % 100 < 97 THEN 'Pending'
       ELSE 'Failed' END AS kyc_status,
  c.c_custkey % 50 = 0 AS is_pep,
  {pick(D.CHANNELS, "c.c_custkey % 6")} AS preferred_channel,
  {day_text("DATE '1990-01-01' + CAST((c.c_custkey * 53) % 1800 AS INTEGER)")} AS customer_since,
  'CRM' AS source_system,
  {RUN_TS} AS record_created_at
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

CTES["ext_accounts"] = f"""
SELECT CAST(k AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  lpad(CAST(k AS VARCHAR), 10, '0') AS account_number,
  product_type, account_status,
  {day_text("opened")} AS open_date,
  CASE WHEN account_status = 'Closed' THEN {day_text("opened + CAST(k % 365 AS INTEGER)")} END AS close_date,
  balance, balance * 0.85::DOUBLE AS available_balance,
  CASE WHEN product_type IN ('Credit Card', 'HELOC')
       THEN CAST(1000 + (k * 13) % 49001 AS DOUBLE) END AS credit_limit,
  CAST(k % 180 AS DOUBLE) / 1000.0::DOUBLE AS interest_rate,
  CAST(k % 110 AS VARCHAR) AS branch_code,
  'USD' AS currency, k % 3 = 0 AS overdraft_protection, k % 2 = 0 AS paperless_enrolled,
  {day_text("opened + CAST(k % 200 AS INTEGER)")} AS last_activity_date,
  'Core Banking' AS source_system, {RUN_TS} AS record_created_at
FROM (SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS opened,
        {pick(D.PRODUCTS, "o_orderkey % 8")} AS product_type,
        CASE WHEN o_orderkey % 100 < 80 THEN 'Active' WHEN o_orderkey % 100 < 88 THEN 'Dormant'
             WHEN o_orderkey % 100 < 97 THEN 'Closed' ELSE 'Suspended' END AS account_status,
        CAST(floor(o_totalprice * 5.0::DOUBLE) AS DOUBLE) / 100.0::DOUBLE AS balance
      FROM orders) o"""

CTES["ext_transactions"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
  CAST(l_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  ttype AS transaction_type, l_extendedprice AS amount, 'USD' AS currency,
  CASE WHEN l_linestatus = 'F' THEN 'Debit' ELSE 'Credit' END AS direction,
  {pick(D.CHANNELS, "l_suppkey % 6")} AS channel,
  CASE WHEN ttype = 'Purchase' THEN 'Merchant_' || CAST(l_suppkey % 200 + 1 AS VARCHAR) END AS merchant_name,
  CASE WHEN ttype = 'Purchase' THEN {pick(D.MERCHANT_CATEGORIES, "l_partkey % 7")} END AS merchant_category,
  {day_text("CAST(l_shipdate AS DATE)")} AS transaction_date,
  lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(CAST(round(l_tax * 100.0::DOUBLE) AS INTEGER) AS VARCHAR), 2, '0') || ':00' AS transaction_time,
  {day_text("CAST(l_shipdate AS DATE) + CAST(l_partkey % 3 AS INTEGER)")} AS posting_date,
  l_quantity * 1000.0::DOUBLE AS balance_after,
  l_returnflag = 'R' AND l_quantity > 45 AS is_flagged,
  l_discount * 10.0::DOUBLE AS fraud_score,
  'REF' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS reference_number,
  ttype || ' line ' || CAST(l_linenumber AS VARCHAR) AS description,
  'Transaction Processing' AS source_system, {RUN_TS} AS record_created_at
FROM (SELECT l.*, o.o_custkey,
        CASE WHEN l.l_linestatus = 'F' THEN {pick(D.DEBIT_TXN_TYPES, "l.l_partkey % 6")}
             ELSE {pick(D.CREDIT_TXN_TYPES, "l.l_partkey % 3")} END AS ttype
      FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey) t"""

CTES["ext_tickets"] = f"""
SELECT CAST(k AS VARCHAR) AS ticket_id,
  CAST(user_id * 10 + k % 10 AS VARCHAR) AS customer_id,
  event_type AS category,
  'Sub_' || CAST(k % 5 + 1 AS VARCHAR) AS sub_category,
  {pick(D.CHANNELS, "k % 6")} AS channel,
  CASE WHEN (k // 3) % 20 < 7 THEN 'Low' WHEN (k // 3) % 20 < 15 THEN 'Medium'
       WHEN (k // 3) % 20 < 19 THEN 'High' ELSE 'Critical' END AS priority,
  status,
  {day_text("created")} AS created_date,
  strftime(ts, '%H:%M:%S') AS created_time,
  CASE WHEN status IN ('Resolved', 'Closed') THEN {day_text("created + CAST(k % 14 + 1 AS INTEGER)")} END AS resolved_date,
  CASE WHEN status IN ('Resolved', 'Closed') THEN {pick(D.RESOLUTIONS, "k % 6")} END AS resolution,
  'AGENT' || CAST(k % 100 + 100 AS VARCHAR) AS agent_id,
  CASE WHEN k % 4 = 0 THEN CAST(k % 110 AS VARCHAR) END AS branch_id,
  CASE WHEN status IN ('Resolved', 'Closed') THEN
    CASE WHEN (k // 10) % 10 = 0 THEN 1 WHEN (k // 10) % 10 = 1 THEN 2 WHEN (k // 10) % 10 = 2 THEN 3
         WHEN (k // 10) % 10 <= 5 THEN 4 ELSE 5 END END AS csat_score,
  (k // 7) % 12 = 0 AS is_escalated,
  'Ticket ' || CAST(k AS VARCHAR) AS notes,
  'CRM' AS source_system, {RUN_TS} AS record_created_at
FROM (SELECT event_id AS k, user_id, event_type, ts, CAST(ts AS DATE) AS created,
        {pick(D.TICKET_STATUSES, "(event_id // 100) % 5")} AS status
      FROM events) e"""

CTES["ext_branches"] = f"""
SELECT CAST(s.s_suppkey AS VARCHAR) AS branch_id, s.s_name AS branch_name,
  {pick(D.BRANCH_TYPES, "s.s_suppkey % 3")} AS branch_type,
  CAST(s.s_suppkey % 997 + 1 AS VARCHAR) || ' Commerce St' AS address,
  'City_' || CAST(s.s_nationkey AS VARCHAR) AS city,
  {state_code("n.n_nationkey")} AS state,
  lpad(CAST((s.s_suppkey * 17) % 100000 AS VARCHAR), 5, '0') AS zip_code,
  '555-' || lpad(CAST(s.s_suppkey % 10000 AS VARCHAR), 4, '0') AS phone,
  'Manager_' || CAST(s.s_suppkey AS VARCHAR) AS manager_name,
  {day_text("DATE '1980-01-01' + CAST((s.s_suppkey * 17) % 10000 AS INTEGER)")} AS open_date,
  s.s_suppkey % 14 <> 0 AS is_active,
  CAST(1 + s.s_suppkey % 6 AS INTEGER) AS atm_count,
  CAST(1000 + (s.s_suppkey * 37) % 7001 AS INTEGER) AS sq_footage,
  {RUN_TS} AS record_created_at
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""


def stamp(ext: str, system: str, file: str) -> str:
    return (f"SELECT *, '{system}' AS _source_system, '{file}' AS _source_file, "
            f"'{BATCH_ID}' AS _batch_id, {RUN_TS} AS _ingest_ts, "
            f"'{DEFAULT.batch_date}' AS _batch_date, TRUE AS _is_current FROM {ext}")


CTES["bronze_customers"] = stamp("ext_customers", "CRM", "customers.csv")
CTES["bronze_accounts"] = stamp("ext_accounts", "Core Banking", "accounts.csv")
CTES["bronze_transactions"] = stamp("ext_transactions", "Transaction Processing", "transactions.csv")
CTES["bronze_branches"] = stamp("ext_branches", "Branch Management", "branches.csv")
CTES["bronze_tickets"] = stamp("ext_tickets", "CRM", "support_tickets.csv")

INGEST = "_ingest_ts DESC NULLS LAST, _batch_id DESC NULLS LAST"

CTES["silver_customers"] = f"""
SELECT customer_id, first_name, last_name, lower(trim(email)) AS email, phone,
  date_of_birth, ssn_last4, address_line1, city, upper(trim(state)) AS state, zip_code, country,
  segment, credit_score, annual_income, trim(kyc_status) AS kyc_status, is_pep,
  preferred_channel, customer_since, source_system, record_created_at,
  _source_system, _ingest_ts, _batch_date,
  age, {band("age", D.AGE_BANDS)} AS age_band,
  {band("annual_income", D.INCOME_TIERS)} AS income_tier,
  {band("credit_score", D.CREDIT_BANDS)} AS credit_band,
  round(date_diff('day', customer_since, {AS_OF}) / 365.25, 1) AS tenure_years,
  {AS_OF} AS scd_start_date, CAST(NULL AS DATE) AS scd_end_date,
  TRUE AS scd_is_current, 1 AS scd_version
FROM (SELECT * REPLACE ({to_date("date_of_birth")} AS date_of_birth,
                        {to_date("customer_since")} AS customer_since,
                        TRY_CAST(credit_score AS INTEGER) AS credit_score,
                        TRY_CAST(annual_income AS DOUBLE) AS annual_income),
        CAST(floor(date_diff('day', {to_date("date_of_birth")}, {AS_OF}) / 365.25) AS INTEGER) AS age
      FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                ORDER BY {INGEST}, record_created_at DESC NULLS LAST) AS _rn
            FROM bronze_customers WHERE _is_current) WHERE _rn = 1) x"""

CTES["silver_accounts"] = f"""
SELECT account_id, customer_id, account_number, product_type, account_status,
  open_date, close_date, balance, available_balance,
  COALESCE(credit_limit, 0.0) AS credit_limit, interest_rate, branch_code, currency,
  overdraft_protection, paperless_enrolled, last_activity_date, source_system,
  record_created_at, _source_system, _ingest_ts, _batch_date,
  {ddiff("last_activity_date", AS_OF)} AS days_since_activity,
  {ddiff("open_date", AS_OF)} AS account_age_days,
  CASE WHEN credit_limit IS NOT NULL AND credit_limit > 0
       THEN round(balance / credit_limit, 4) END AS utilization_rate
FROM (SELECT * REPLACE ({to_date("open_date")} AS open_date, {to_date("close_date")} AS close_date,
                        {to_date("last_activity_date")} AS last_activity_date)
      FROM (SELECT *, row_number() OVER (PARTITION BY account_id
                ORDER BY {INGEST}, record_created_at DESC NULLS LAST) AS _rn
            FROM bronze_accounts) WHERE _rn = 1) x"""

CTES["silver_transactions"] = f"""
SELECT transaction_id, account_id, customer_id, transaction_type, amount, currency, direction,
  channel, merchant_name, merchant_category, transaction_date, transaction_time, posting_date,
  balance_after, is_flagged, fraud_score, reference_number, description, source_system,
  record_created_at, _source_system, _ingest_ts, _batch_date,
  CASE WHEN direction = 'Debit' THEN -amount ELSE amount END AS signed_amount,
  CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS txn_day_of_week,
  CAST(month(transaction_date) AS INTEGER) AS txn_month,
  CAST(year(transaction_date) AS INTEGER) AS txn_year,
  CAST(quarter(transaction_date) AS INTEGER) AS txn_quarter,
  {ddiff("transaction_date", "posting_date")} AS settlement_lag_days
FROM (SELECT * REPLACE ({to_date("transaction_date")} AS transaction_date,
                        {to_date("posting_date")} AS posting_date)
      FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
                ORDER BY {INGEST}, transaction_date DESC NULLS LAST, reference_number NULLS LAST,
                         amount NULLS LAST, balance_after NULLS LAST, fraud_score NULLS LAST,
                         transaction_time NULLS LAST) AS _rn
            FROM bronze_transactions) WHERE _rn = 1) x"""

CTES["silver_branches"] = f"""
SELECT branch_id, branch_name, branch_type, address, city, state, zip_code, phone,
  manager_name, {to_date("open_date")} AS open_date, is_active, atm_count, sq_footage,
  record_created_at, _source_system, _ingest_ts, _batch_date
FROM bronze_branches"""

CTES["silver_tickets"] = f"""
SELECT ticket_id, customer_id, category, sub_category, channel, priority, status,
  created_date, created_time, resolved_date, resolution, agent_id, branch_id, csat_score,
  is_escalated, notes, source_system, record_created_at, _source_system, _ingest_ts, _batch_date,
  CASE WHEN resolved_date IS NOT NULL THEN {ddiff("created_date", "resolved_date")} END AS resolution_days,
  status IN ('Resolved', 'Closed') AS is_resolved
FROM (SELECT * REPLACE ({to_date("created_date")} AS created_date,
                        {to_date("resolved_date")} AS resolved_date)
      FROM (SELECT *, row_number() OVER (PARTITION BY ticket_id
                ORDER BY {INGEST}, record_created_at DESC NULLS LAST) AS _rn
            FROM bronze_tickets) WHERE _rn = 1) x"""

CTES["account_kpis"] = f"""
SELECT customer_id, COUNT(account_id) AS active_account_count,
  {xsum("balance")} AS total_balance, {xavg("balance")} AS avg_balance, MAX(balance) AS max_account_balance,
  {xsum("credit_limit")} AS total_credit_limit,
  list_sort(list(DISTINCT product_type) FILTER (WHERE product_type IS NOT NULL)) AS product_types_held,
  COUNT(DISTINCT product_type) AS product_diversity_count,
  MIN(open_date) AS oldest_account_date, AVG(days_since_activity) AS avg_days_since_activity
FROM silver_accounts WHERE account_status = 'Active' GROUP BY customer_id"""

DEBIT = "CASE WHEN direction = 'Debit' THEN amount ELSE 0.0 END"
CREDIT = "CASE WHEN direction = 'Credit' THEN amount ELSE 0.0 END"

CTES["txn_kpis"] = f"""
SELECT customer_id, COUNT(transaction_id) AS total_transactions,
  {xsum(DEBIT)} AS total_spend_12m, {xsum(CREDIT)} AS total_deposits_12m,
  {xavg("amount")} AS avg_txn_amount, MAX(amount) AS max_txn_amount,
  MAX(transaction_date) AS last_transaction_date,
  CAST(SUM(CAST(is_flagged AS INTEGER)) AS BIGINT) AS flagged_txn_count,
  {xavg("fraud_score")} AS avg_fraud_score,
  COUNT(DISTINCT channel) AS distinct_channels_used
FROM silver_transactions GROUP BY customer_id"""

CTES["ticket_kpis"] = """
SELECT customer_id, COUNT(ticket_id) AS total_tickets,
  CAST(SUM(CAST(is_escalated AS INTEGER)) AS BIGINT) AS escalated_tickets,
  AVG(resolution_days) AS avg_resolution_days, AVG(csat_score) AS avg_csat_score,
  MAX(created_date) AS last_ticket_date, COUNT(DISTINCT category) AS distinct_ticket_categories
FROM silver_tickets GROUP BY customer_id"""

CTES["customer_360"] = f"""
SELECT customer_id, first_name, last_name, email, segment, age, age_band, income_tier,
  credit_band, credit_score, annual_income, state, city, kyc_status, is_pep, customer_since,
  tenure_years, preferred_channel, active_account_count, total_balance, avg_balance,
  total_credit_limit, product_diversity_count, product_types_held, total_transactions,
  total_spend_12m, total_deposits_12m, avg_txn_amount, max_txn_amount,
  total_deposits_12m - total_spend_12m AS net_cash_flow_12m,
  days_since_last_txn, last_transaction_date,
  CASE WHEN active_account_count > 0 THEN round(total_transactions / active_account_count, 2)
       ELSE 0.0 END AS txn_per_account,
  flagged_txn_count, avg_fraud_score, total_tickets, escalated_tickets, avg_csat_score,
  avg_resolution_days, last_ticket_date,
  (days_since_last_txn > {D.CHURN_INACTIVE_DAYS} OR avg_csat_score < {D.CHURN_MIN_CSAT}
   OR escalated_tickets > {D.CHURN_MAX_ESCALATIONS}) AS churn_risk_flag,
  (total_balance > {D.HIGH_VALUE_BALANCE} OR segment IN {inlist(D.HIGH_VALUE_SEGMENTS)}) AS high_value_flag,
  {RUN_TS} AS gold_created_at
FROM (SELECT c.*, a.* EXCLUDE (customer_id, active_account_count, total_balance),
        COALESCE(a.active_account_count, 0) AS active_account_count,
        COALESCE(a.total_balance, 0.0) AS total_balance,
        t.* EXCLUDE (customer_id, total_transactions, total_spend_12m, total_deposits_12m, flagged_txn_count),
        COALESCE(t.total_transactions, 0) AS total_transactions,
        COALESCE(t.total_spend_12m, 0.0) AS total_spend_12m,
        COALESCE(t.total_deposits_12m, 0.0) AS total_deposits_12m,
        COALESCE(t.flagged_txn_count, 0) AS flagged_txn_count,
        k.* EXCLUDE (customer_id, total_tickets, escalated_tickets),
        COALESCE(k.total_tickets, 0) AS total_tickets,
        COALESCE(k.escalated_tickets, 0) AS escalated_tickets,
        {ddiff("t.last_transaction_date", AS_OF)} AS days_since_last_txn
      FROM (SELECT * FROM silver_customers WHERE scd_is_current) c
      LEFT JOIN account_kpis a ON c.customer_id = a.customer_id
      LEFT JOIN txn_kpis t ON c.customer_id = t.customer_id
      LEFT JOIN ticket_kpis k ON c.customer_id = k.customer_id) j"""

CTES["txn_monthly_summary"] = f"""
SELECT customer_id, txn_year, txn_month, COUNT(transaction_id) AS txn_count,
  {xsum(DEBIT)} AS total_debit, {xsum(CREDIT)} AS total_credit,
  {xavg("amount")} AS avg_txn_amount, MAX(fraud_score) AS max_fraud_score,
  CAST(SUM(CAST(is_flagged AS INTEGER)) AS BIGINT) AS flagged_count,
  COUNT(DISTINCT channel) AS channels_used,
  {xsum(CREDIT)} - {xsum(DEBIT)} AS net_flow,
  concat_ws('-', CAST(txn_year AS VARCHAR), lpad(CAST(txn_month AS VARCHAR), 2, '0')) AS period
FROM silver_transactions GROUP BY customer_id, txn_year, txn_month"""

CTES["segment_metrics"] = f"""
SELECT *, round(churn_risk_count / customer_count * 100, 2) AS churn_risk_pct,
  round(high_value_count / customer_count * 100, 2) AS high_value_pct,
  {RUN_TS} AS calculated_at
FROM (SELECT segment, COUNT(customer_id) AS customer_count,
        {xavg("total_balance")} AS avg_total_balance, AVG(credit_score) AS avg_credit_score,
        {xavg("annual_income")} AS avg_annual_income, AVG(product_diversity_count) AS avg_products_held,
        AVG(total_transactions) AS avg_txn_count, {xavg("total_spend_12m")} AS avg_spend_12m,
        {xsum("total_balance")} AS aum_total,
        CAST(SUM(CAST(churn_risk_flag AS INTEGER)) AS BIGINT) AS churn_risk_count,
        CAST(SUM(CAST(high_value_flag AS INTEGER)) AS BIGINT) AS high_value_count,
        {xavg("avg_csat_score")} AS avg_csat, {xavg("tenure_years")} AS avg_tenure_years
      FROM customer_360 GROUP BY segment) s"""

CTES["support_kpis"] = f"""
SELECT *, round(resolved_count / ticket_count * 100, 2) AS resolution_rate,
  round(escalation_count / ticket_count * 100, 2) AS escalation_rate,
  {RUN_TS} AS calculated_at
FROM (SELECT created_date, category, priority, COUNT(ticket_id) AS ticket_count,
        CAST(SUM(CAST(is_escalated AS INTEGER)) AS BIGINT) AS escalation_count,
        AVG(resolution_days) AS avg_resolution_days, AVG(csat_score) AS avg_csat,
        COUNT(DISTINCT customer_id) AS distinct_customers,
        CAST(SUM(CAST(is_resolved AS INTEGER)) AS BIGINT) AS resolved_count
      FROM silver_tickets GROUP BY created_date, category, priority) s"""


def _deps(sql: str, seen: list[str]) -> None:
    for name in CTES:
        if name in seen:
            continue
        if re.search(rf"\b{name}\b", sql):
            _deps(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it references, in dependency order."""
    if extra:
        for k, v in extra.items():
            CTES.setdefault(k, v)
    seen: list[str] = []
    _deps(sql, seen)
    if not seen:
        return sql.strip()
    body = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in seen)
    return f"WITH {body}\n{sql.strip()}"
