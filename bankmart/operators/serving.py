"""Typed serving load: positional typed projection, bad rows to rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bankmart.config import RunConfig, DEFAULT

# fixed values: serving schema of the Customer 360 table (name, SQL type,
# maximum text length), in declared order; product_types_held is kept as an
# array because the serving queries read it.
C360_SERVING = [
    ("customer_id", "string", 36), ("first_name", "string", 100),
    ("last_name", "string", 100), ("email", "string", 255), ("segment", "string", 50),
    ("age", "int", None), ("age_band", "string", 30), ("income_tier", "string", 20),
    ("credit_band", "string", 20), ("credit_score", "int", None),
    ("annual_income", "double", None), ("state", "string", 2), ("city", "string", 100),
    ("kyc_status", "string", 20), ("is_pep", "boolean", None),
    ("customer_since", "date", None), ("tenure_years", "double", None),
    ("preferred_channel", "string", 30), ("active_account_count", "int", None),
    ("total_balance", "double", None), ("avg_balance", "double", None),
    ("total_credit_limit", "double", None), ("product_diversity_count", "int", None),
    ("product_types_held", "array<string>", None),
    ("total_transactions", "int", None), ("total_spend_12m", "double", None),
    ("total_deposits_12m", "double", None), ("avg_txn_amount", "double", None),
    ("max_txn_amount", "double", None), ("net_cash_flow_12m", "double", None),
    ("days_since_last_txn", "int", None), ("last_transaction_date", "date", None),
    ("txn_per_account", "double", None), ("flagged_txn_count", "int", None),
    ("avg_fraud_score", "double", None), ("total_tickets", "int", None),
    ("escalated_tickets", "int", None), ("avg_csat_score", "double", None),
    ("avg_resolution_days", "double", None), ("last_ticket_date", "date", None),
    ("churn_risk_flag", "boolean", None), ("high_value_flag", "boolean", None),
    ("gold_created_at", "timestamp_ntz", None),
]
TXN_MONTHLY_SERVING = [
    ("customer_id", "string", 36), ("txn_year", "int", None), ("txn_month", "int", None),
    ("period", "string", 7), ("txn_count", "int", None), ("total_debit", "double", None),
    ("total_credit", "double", None), ("avg_txn_amount", "double", None),
    ("max_fraud_score", "double", None), ("flagged_count", "int", None),
    ("channels_used", "int", None), ("net_flow", "double", None),
]
SEGMENT_SERVING = [
    ("segment", "string", 50), ("customer_count", "int", None),
    ("avg_total_balance", "double", None), ("avg_credit_score", "double", None),
    ("avg_annual_income", "double", None), ("avg_products_held", "double", None),
    ("avg_txn_count", "double", None), ("avg_spend_12m", "double", None),
    ("aum_total", "double", None), ("churn_risk_count", "int", None),
    ("high_value_count", "int", None), ("churn_risk_pct", "double", None),
    ("high_value_pct", "double", None), ("avg_csat", "double", None),
    ("avg_tenure_years", "double", None), ("calculated_at", "timestamp_ntz", None),
]
SUPPORT_SERVING = [
    ("created_date", "date", None), ("category", "string", 100), ("priority", "string", 20),
    ("ticket_count", "int", None), ("escalation_count", "int", None),
    ("avg_resolution_days", "double", None), ("avg_csat", "double", None),
    ("distinct_customers", "int", None), ("resolved_count", "int", None),
    ("resolution_rate", "double", None), ("escalation_rate", "double", None),
    ("calculated_at", "timestamp_ntz", None),
]
DQ_SERVING = [
    ("batch_id", "string", 20), ("run_ts", "string", 30), ("table_name", "string", 100),
    ("check_name", "string", 200), ("rule", "string", 500), ("status", "string", 10),
    ("failing_count", "int", None), ("total_count", "int", None), ("pass_pct", "double", None),
]
# serving table → (spec, NOT NULL columns)
SERVING = {
    "customer_360": (C360_SERVING, {"customer_id"}),
    "txn_monthly_summary": (TXN_MONTHLY_SERVING, {"customer_id"}),
    "segment_metrics": (SEGMENT_SERVING, {"segment"}),
    "support_kpis": (SUPPORT_SERVING, set()),
    "dq_results": (DQ_SERVING, set()),
}
NOT_NULL = {"customer_id"}


STATUS, LOADED, REJECTED = "_load_status", "loaded", "rejected"
REASONS, RAW, LOAD_TS = "_reasons", "_raw", "_sf_load_ts"


def _problems(name: str, typ: str, max_len, not_null=NOT_NULL) -> list[Column]:
    """Reason codes ``column:code`` of one column, NULL where there is none:
    ``type`` (a value that does not cast), ``length``, ``missing``."""
    src = F.col(name)
    found = [F.when(src.isNotNull() & src.try_cast(typ).isNull(), f"{name}:type")]
    if max_len is not None:
        found.append(F.when(F.length(src.cast("string")) > max_len, f"{name}:length"))
    if name in not_null:
        found.append(F.when(src.isNull(), f"{name}:missing"))
    return found


def with_reasons(staged: DataFrame, spec=C360_SERVING, not_null=NOT_NULL) -> DataFrame:
    """Staged rows with all their reason codes, in declared order."""
    codes = F.array_compact(F.array(*[p for n, t, m in spec for p in _problems(n, t, m, not_null)]))
    return staged.withColumn(REASONS, codes)


def _typed(spec) -> list[Column]:
    return [F.col(n).try_cast(t).alias(n) for n, t, _ in spec]


def typed_load(staged: DataFrame, spec=C360_SERVING, cfg: RunConfig = DEFAULT,
               not_null=NOT_NULL):
    """Return ``(loaded, rejects)``.

    A row is rejected when a non-NULL value does not cast to the declared
    type, a text is longer than declared, or a NOT NULL key is missing —
    telling "was NULL" apart from "failed cast" with ``c IS NOT NULL AND
    try_cast(c) IS NULL``.  Loaded rows get the load timestamp, rejected ones keep their
    staged values and every reason.
    """
    flagged = with_reasons(staged, spec, not_null)
    good = F.size(REASONS) == 0
    loaded = flagged.where(good).select(*_typed(spec), cfg.run_ts_col().alias(LOAD_TS))
    return loaded, flagged.where(~good)


def load_table(staged: DataFrame, table: str, cfg: RunConfig = DEFAULT):
    spec, not_null = SERVING[table]
    return typed_load(staged, spec, cfg, not_null)


# clustering of the served tables (range-partitioned by it)
CLUSTER_BY = {"customer_360": ["segment", "state", "customer_id"],
              "txn_monthly_summary": ["txn_year", "txn_month", "customer_id"]}


def load(staged: DataFrame, table: str, path: str, cfg: RunConfig = DEFAULT) -> dict[str, int]:
    """Load a staged table in one pass: typed rows and rejects are two partitions of one
    write, clustered where the table has a clustering.  A rejected row keeps its staged
    values as JSON and its reason codes.  Returns staged, loaded and rejected rows, counted
    by the write; they must add up."""
    spec, not_null = SERVING[table]
    bad = F.size(REASONS) > 0
    raw = F.to_json(F.struct(*[F.col(c) for c in staged.columns]))
    flagged = with_reasons(staged, spec, not_null)
    rows = flagged.select(*_typed(spec), cfg.run_ts_col().alias(LOAD_TS), REASONS, F.when(bad, raw).alias(RAW),
                          F.when(bad, REJECTED).otherwise(LOADED).alias(STATUS))
    if table in CLUSTER_BY:
        order = [STATUS, *CLUSTER_BY[table]]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("staged"),
                        F.count_if(F.col(STATUS) == LOADED).alias("loaded"),
                        F.count_if(F.col(STATUS) == REJECTED).alias("rejected"))
    rows.write.mode("overwrite").partitionBy(STATUS).parquet(path)
    counts = dict(seen.get)
    if counts["loaded"] + counts["rejected"] != counts["staged"]:
        raise ValueError(f"load of {table} does not add up: {counts}")
    return counts


def _read(spark, path: str, status: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col(STATUS) == status)


def read_loaded(spark, path: str, table: str) -> DataFrame:
    return _read(spark, path, LOADED).select(*[n for n, _, _ in SERVING[table][0]], LOAD_TS)


def read_rejects(spark, path: str) -> DataFrame:
    return _read(spark, path, REJECTED).select(RAW, REASONS)
