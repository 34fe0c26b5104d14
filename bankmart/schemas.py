"""Explicit schemas of the five source extracts and of the audit table.

Types are declared, never inferred: inference turns zip ``01234`` into an
integer and a time-of-day into a timestamp.
"""

from pyspark.sql import types as T

S, I, D, B, TS, L = (T.StringType(), T.IntegerType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampNTZType(), T.LongType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMERS = _struct(
    ("customer_id", S), ("first_name", S), ("last_name", S), ("email", S),
    ("phone", S), ("date_of_birth", S), ("ssn_last4", S), ("address_line1", S),
    ("city", S), ("state", S), ("zip_code", S), ("country", S), ("segment", S),
    ("credit_score", I), ("annual_income", D), ("kyc_status", S),
    ("is_pep", B), ("preferred_channel", S), ("customer_since", S),
    ("source_system", S), ("record_created_at", TS))

ACCOUNTS = _struct(
    ("account_id", S), ("customer_id", S), ("account_number", S),
    ("product_type", S), ("account_status", S), ("open_date", S),
    ("close_date", S), ("balance", D), ("available_balance", D),
    ("credit_limit", D), ("interest_rate", D), ("branch_code", S),
    ("currency", S), ("overdraft_protection", B), ("paperless_enrolled", B),
    ("last_activity_date", S), ("source_system", S), ("record_created_at", TS))

TRANSACTIONS = _struct(
    ("transaction_id", S), ("account_id", S), ("customer_id", S),
    ("transaction_type", S), ("amount", D), ("currency", S), ("direction", S),
    ("channel", S), ("merchant_name", S), ("merchant_category", S),
    ("transaction_date", S), ("transaction_time", S), ("posting_date", S),
    ("balance_after", D), ("is_flagged", B), ("fraud_score", D),
    ("reference_number", S), ("description", S), ("source_system", S),
    ("record_created_at", TS))

BRANCHES = _struct(
    ("branch_id", S), ("branch_name", S), ("branch_type", S), ("address", S),
    ("city", S), ("state", S), ("zip_code", S), ("phone", S),
    ("manager_name", S), ("open_date", S), ("is_active", B), ("atm_count", I),
    ("sq_footage", I), ("record_created_at", TS))

TICKETS = _struct(
    ("ticket_id", S), ("customer_id", S), ("category", S), ("sub_category", S),
    ("channel", S), ("priority", S), ("status", S), ("created_date", S),
    ("created_time", S), ("resolved_date", S), ("resolution", S),
    ("agent_id", S), ("branch_id", S), ("csat_score", I), ("is_escalated", B),
    ("notes", S), ("source_system", S), ("record_created_at", TS))

SOURCES = {"customers": CUSTOMERS, "accounts": ACCOUNTS,
           "transactions": TRANSACTIONS, "branches": BRANCHES,
           "support_tickets": TICKETS}

# per-source: (system name, natural key, business date column for layout)
SOURCE_META = {
    "customers": ("CRM", "customer_id", None),
    "accounts": ("Core Banking", "account_id", None),
    "transactions": ("Transaction Processing", "transaction_id", "transaction_date"),
    "branches": ("Branch Management", "branch_id", None),
    "support_tickets": ("CRM", "ticket_id", "created_date"),
}

DQ_RESULTS = T.StructType([
    T.StructField("batch_id", S, False), T.StructField("run_ts", S, False),
    T.StructField("table_name", S, False), T.StructField("check_name", S, False),
    T.StructField("rule", S, False), T.StructField("status", S, False),
    T.StructField("failing_count", L, False), T.StructField("total_count", L, False),
    T.StructField("pass_pct", D, False)])

BRONZE_META = ["_source_system", "_source_file", "_batch_id", "_ingest_ts",
               "_batch_date", "_is_current"]
