"""Oracle SQL for the write-and-read-back jobs."""

from __future__ import annotations

from bankmart.oracle.base import BATCH_ID, RUN_TS
from bankmart.oracle.queries import add

_SOURCES = {"customers": "customers", "accounts": "accounts", "transactions": "transactions",
            "branches": "branches", "support_tickets": "tickets"}
add("csv_scan", " UNION ALL BY NAME ".join(
    f"SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record, '{n}' AS table_name FROM ext_{c}" for n, c in _SOURCES.items()))
_MONTH = {"transactions": "transaction_date", "support_tickets": "created_date"}


def _month(n: str) -> str:
    day = _MONTH.get(n)
    return f", coalesce(strftime(try_cast({day} AS date), '%Y-%m'), 'unknown') AS _month" if day else ""


add("bronze_append", " UNION ALL BY NAME ".join(
    f"SELECT *{_month(n)}, '{n}' AS table_name FROM bronze_{c}" for n, c in _SOURCES.items()))
_KEYS = {"customers": "customer_id", "accounts": "account_id", "transactions": "account_id",
         "branches": "branch_id", "support_tickets": "ticket_id"}
add("ingest_ledger", " UNION ALL ".join(
    f"SELECT '{BATCH_ID}' AS batch_id, '{n}' AS table_name, COUNT(*) AS file_rows, "
    f"COUNT(*) FILTER (CAST({_KEYS[n]} AS BIGINT) % 97 <> 0) AS loaded, "
    f"COUNT(*) FILTER (CAST({_KEYS[n]} AS BIGINT) % 97 = 0) AS quarantined FROM ext_{c}" for n, c in _SOURCES.items()))
_FIRST = {**_KEYS, "transactions": "transaction_id"}
add("csv_quarantine", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{BATCH_ID}' AS batch_id, {_FIRST[n]} AS record_key FROM ext_{c} "
    f"WHERE CAST({_KEYS[n]} AS BIGINT) % 97 = 0" for n, c in _SOURCES.items()))
add("full_refresh", "SELECT * FROM bronze_branches")
add("partitioned_overwrite", "SELECT * FROM silver_transactions")
add("dq_audit_append", """
SELECT * REPLACE ('20011103_000000' AS batch_id, '2001-11-03T00:00:00' AS run_ts) FROM dq_results
UNION ALL SELECT * FROM dq_results""")
add("clustered_rewrite", " UNION ALL BY NAME ".join(
    f"SELECT *, '{t}' AS table_name FROM {t}" for t in ("customer_360", "txn_monthly_summary", "silver_transactions")))
add("compact_files", "SELECT * FROM silver_transactions")

#: serving columns and types, stated apart from the loader's
_C360 = """customer_id VARCHAR 36, first_name VARCHAR 100, last_name VARCHAR 100, email VARCHAR 255, segment VARCHAR 50,
age INTEGER, age_band VARCHAR 30, income_tier VARCHAR 20, credit_band VARCHAR 20, credit_score INTEGER,
annual_income DOUBLE, state VARCHAR 2, city VARCHAR 100, kyc_status VARCHAR 20, is_pep BOOLEAN, customer_since DATE,
tenure_years DOUBLE, preferred_channel VARCHAR 30, active_account_count INTEGER, total_balance DOUBLE,
avg_balance DOUBLE, total_credit_limit DOUBLE, product_diversity_count INTEGER, product_types_held VARCHAR[],
total_transactions INTEGER, total_spend_12m DOUBLE, total_deposits_12m DOUBLE, avg_txn_amount DOUBLE,
max_txn_amount DOUBLE, net_cash_flow_12m DOUBLE, days_since_last_txn INTEGER, last_transaction_date DATE,
txn_per_account DOUBLE, flagged_txn_count INTEGER, avg_fraud_score DOUBLE, total_tickets INTEGER,
escalated_tickets INTEGER, avg_csat_score DOUBLE, avg_resolution_days DOUBLE, last_ticket_date DATE,
churn_risk_flag BOOLEAN, high_value_flag BOOLEAN, gold_created_at TIMESTAMP"""
_MONTHLY = """customer_id VARCHAR 36, txn_year INTEGER, txn_month INTEGER, period VARCHAR 7, txn_count INTEGER,
total_debit DOUBLE, total_credit DOUBLE, avg_txn_amount DOUBLE, max_fraud_score DOUBLE, flagged_count INTEGER,
channels_used INTEGER, net_flow DOUBLE"""
_SEGMENT = """segment VARCHAR 50, customer_count INTEGER, avg_total_balance DOUBLE, avg_credit_score DOUBLE,
avg_annual_income DOUBLE, avg_products_held DOUBLE, avg_txn_count DOUBLE, avg_spend_12m DOUBLE, aum_total DOUBLE,
churn_risk_count INTEGER, high_value_count INTEGER, churn_risk_pct DOUBLE, high_value_pct DOUBLE, avg_csat DOUBLE,
avg_tenure_years DOUBLE, calculated_at TIMESTAMP"""
_SUPPORT = """created_date DATE, category VARCHAR 100, priority VARCHAR 20, ticket_count INTEGER,
escalation_count INTEGER, avg_resolution_days DOUBLE, avg_csat DOUBLE, distinct_customers INTEGER,
resolved_count INTEGER, resolution_rate DOUBLE, escalation_rate DOUBLE, calculated_at TIMESTAMP"""
_AUDIT = """batch_id VARCHAR 20, run_ts VARCHAR 30, table_name VARCHAR 100, check_name VARCHAR 200, rule VARCHAR 500,
status VARCHAR 10, failing_count INTEGER, total_count INTEGER, pass_pct DOUBLE"""
_SERVED = {"customer_360": (_C360, ["customer_id"]), "txn_monthly_summary": (_MONTHLY, ["customer_id"]),
           "segment_metrics": (_SEGMENT, ["segment"]), "support_kpis": (_SUPPORT, []), "dq_results": (_AUDIT, [])}


def _codes(name: str) -> str:
    """Reason codes of a staged row, comma-joined in declared order."""
    found = []
    columns, needed = _SERVED[name]
    for c, t, *longest in (x.split() for x in columns.replace("\n", " ").split(", ")):
        found.append(f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN '{c}:type' END")
        if longest:
            found.append(f"CASE WHEN length(CAST({c} AS VARCHAR)) > {longest[0]} THEN '{c}:length' END")
        if c in needed:
            found.append(f"CASE WHEN {c} IS NULL THEN '{c}:missing' END")
    return f"concat_ws(',', {', '.join(found)})"


def _loaded(name: str) -> str:
    casts = ", ".join(f"TRY_CAST({c} AS {t}) AS {c}" for c, t, *_ in
                      (x.split() for x in _SERVED[name][0].replace("\n", " ").split(", ")))
    # the audit's own table_name gives way to the served table's name
    casts = casts.replace("TRY_CAST(table_name AS VARCHAR) AS table_name, ", "")
    return (f"SELECT {casts}, {RUN_TS} AS _sf_load_ts, '{name}' AS table_name FROM {name} WHERE {_codes(name)} = ''")


add("serving_load", " UNION ALL BY NAME ".join(_loaded(n) for n in _SERVED))

_N = "CAST(customer_id AS BIGINT)"
_DAMAGED = {
    "customer_360": f"SELECT * REPLACE (CASE WHEN {_N} % 89 = 0 THEN 'Nowhere' ELSE state END AS state, "
                    f"CASE WHEN {_N} % 83 = 0 THEN 'n/a' ELSE CAST(credit_score AS VARCHAR) END AS credit_score) FROM customer_360",
    "txn_monthly_summary": f"SELECT * REPLACE (CASE WHEN {_N} % 79 <> 0 THEN customer_id END AS customer_id, "
                           f"CASE WHEN {_N} % 73 = 0 THEN 'many' ELSE CAST(txn_count AS VARCHAR) END AS txn_count) "
                           "FROM txn_monthly_summary",
    "segment_metrics": "SELECT * FROM segment_metrics",
    "support_kpis": "SELECT * REPLACE (CASE WHEN priority = 'Low' THEN repeat(priority, 9) ELSE priority END AS priority) "
                    "FROM support_kpis",
    "dq_results": "SELECT * FROM dq_results"}
add("serving_rejects", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {_codes(n)} AS reasons, COUNT(*) AS row_count FROM ({sql}) t "
    f"WHERE {_codes(n)} <> '' GROUP BY ALL" for n, sql in _DAMAGED.items()))
add("serving_ledger", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS staged, COUNT(*) FILTER ({_codes(n)} = '') AS loaded, "
    f"COUNT(*) FILTER ({_codes(n)} <> '') AS rejected FROM ({sql}) t" for n, sql in _DAMAGED.items()))
add("registered_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in
    ["silver_customers", "silver_accounts", "silver_transactions", "silver_branches", "silver_tickets",
     "customer_360", "txn_monthly_summary", "segment_metrics", "support_kpis", "dq_results"]))
