"""Silver: typed, de-duplicated, standardised entity tables.

Text from the landing files is parsed with ``try_*`` functions: with ANSI
mode on, a bad value becomes NULL (and is caught by the DQ rules) instead
of failing the whole job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart import domains as D
from bankmart.config import RunConfig, DEFAULT
from bankmart.functions.bands import age_band, income_tier, credit_band
from bankmart.operators.dedup import dedup_latest, INGEST_ORDER
from bankmart.sources.adapters import TRANSACTION_TIE_BREAK

DROP_META = ["_source_file", "_batch_id", "_is_current"]
DATE_FMT = "yyyy-MM-dd"


def _date(c: str):
    return F.try_to_date(F.col(c), DATE_FMT)


def _as_of(cfg: RunConfig):
    return F.lit(cfg.as_of)


def clean_customers(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """Latest row per customer, typed and standardised, with derived bands.

    Returns the *incoming* customer state (no SCD2 columns); see
    :mod:`bankmart.operators.scd2` for versioning.
    """
    df = dedup_latest(bronze.where(F.col("_is_current")), ["customer_id"],
                      INGEST_ORDER + [("record_created_at", "desc")])
    days_alive = F.datediff(_as_of(cfg), F.col("date_of_birth"))
    return (df
            .withColumns({
                "date_of_birth": _date("date_of_birth"),
                "customer_since": _date("customer_since"),
                "credit_score": F.col("credit_score").try_cast("int"),
                "annual_income": F.col("annual_income").try_cast("double"),
                "email": F.lower(F.trim(F.col("email"))),
                "state": F.upper(F.trim(F.col("state"))),
                "kyc_status": F.trim(F.col("kyc_status")),
            })
            .withColumn("age", F.floor(days_alive / F.lit(365.25)).cast("int"))
            .withColumns({
                "age_band": age_band("age"),
                "income_tier": income_tier("annual_income"),
                "credit_band": credit_band("credit_score"),
                "tenure_years": F.round(F.datediff(_as_of(cfg), F.col("customer_since"))
                                        / F.lit(365.25), 1),
            })
            .drop(*DROP_META))


def silver_customers(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """First-load customer dimension: every row version 1, open interval."""
    from bankmart.operators.scd2 import scd2_initial
    return scd2_initial(clean_customers(bronze, cfg), cfg)


def clean_accounts(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """Latest row per account, typed; nothing in it depends on the run's date."""
    df = dedup_latest(bronze, ["account_id"],
                      INGEST_ORDER + [("record_created_at", "desc")])
    limit = F.col("credit_limit")
    return (df
            .withColumns({
                "open_date": _date("open_date"),
                "close_date": _date("close_date"),
                "last_activity_date": _date("last_activity_date"),
                "balance": F.col("balance").try_cast("double"),
                "available_balance": F.col("available_balance").try_cast("double"),
                "interest_rate": F.col("interest_rate").try_cast("double"),
                "credit_limit": limit.try_cast("double"),
            })
            .withColumn("utilization_rate", F.when(limit.isNotNull() & (limit > 0),
                                                   F.round(F.col("balance") / limit, 4)))
            .withColumn("credit_limit", F.coalesce(limit, F.lit(0.0)))
            .drop(*DROP_META))


def aged_accounts(accounts: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """Clean accounts with their days as of the run's date."""
    return accounts.withColumns({
        "days_since_activity": F.datediff(_as_of(cfg), F.col("last_activity_date")),
        "account_age_days": F.datediff(_as_of(cfg), F.col("open_date"))})


def silver_accounts(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    return aged_accounts(clean_accounts(bronze, cfg), cfg)


def silver_transactions(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    df = dedup_latest(bronze, ["transaction_id"], INGEST_ORDER + TRANSACTION_TIE_BREAK)
    tdate = F.col("transaction_date")
    return (df
            .withColumns({
                "transaction_date": _date("transaction_date"),
                "posting_date": _date("posting_date"),
                "amount": F.col("amount").try_cast("double"),
                "balance_after": F.col("balance_after").try_cast("double"),
                "fraud_score": F.col("fraud_score").try_cast("double"),
                "is_flagged": F.col("is_flagged").try_cast("boolean"),
            })
            .withColumns({
                "signed_amount": F.when(F.col("direction") == "Debit", -F.col("amount"))
                                  .otherwise(F.col("amount")),
                "txn_day_of_week": F.dayofweek(tdate),
                "txn_month": F.month(tdate),
                "txn_year": F.year(tdate),
                "txn_quarter": F.quarter(tdate),
                "settlement_lag_days": F.datediff(F.col("posting_date"), tdate),
            })
            .drop(*DROP_META))


def silver_branches(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """Reference table, full refresh: no de-duplication."""
    return (bronze
            .withColumns({
                "open_date": _date("open_date"),
                "is_active": F.col("is_active").try_cast("boolean"),
                "atm_count": F.col("atm_count").try_cast("int"),
                "sq_footage": F.col("sq_footage").try_cast("int"),
            })
            .drop(*DROP_META))


def silver_tickets(bronze: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    df = dedup_latest(bronze, ["ticket_id"],
                      INGEST_ORDER + [("record_created_at", "desc")])
    return (df
            .withColumns({
                "created_date": _date("created_date"),
                "resolved_date": _date("resolved_date"),
                "csat_score": F.col("csat_score").try_cast("int"),
                "is_escalated": F.col("is_escalated").try_cast("boolean"),
            })
            .withColumns({
                "resolution_days": F.when(F.col("resolved_date").isNotNull(),
                                          F.datediff(F.col("resolved_date"),
                                                     F.col("created_date"))),
                "is_resolved": F.col("status").isin(*D.RESOLVED_STATUSES),
            })
            .drop(*DROP_META))
