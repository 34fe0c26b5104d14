"""Adapters: driver test tables → the five banking source extracts.

The test data is a TPC-H-like star schema.  Each banking entity is derived
from one table (plus a broadcastable dimension) with integer arithmetic,
``floor`` and CASE only, so the same values come out of any SQL engine.
``k`` below is the row's own integer key.  Output columns and types are the
source-extract schemas in :mod:`bankmart.schemas` (dates as ``yyyy-MM-dd``
text, like the CSV landing files).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart import domains as D
from bankmart import schemas
from bankmart.config import RunConfig, DEFAULT
from bankmart.functions.lookup import pick, case_map
from bankmart.sources.tables import read_table

# fixed values: mapping of the test market segment onto the bank segment
MKT_SEGMENT_TO_SEGMENT = {"AUTOMOBILE": "Retail", "BUILDING": "Premier",
                          "FURNITURE": "Private", "HOUSEHOLD": "SMB",
                          "MACHINERY": "Corporate"}
# number of branch codes an account can point at (some have no branch row)
BRANCH_CODE_SPACE = 110


def _run_ts(cfg: RunConfig) -> Column:
    return cfg.run_ts_col()


def _day_text(start: date, offset: Column) -> Column:
    return F.date_format(F.date_add(F.lit(start), offset.cast("int")), "yyyy-MM-dd")


def _text(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _state_code(nationkey: Column) -> Column:
    """Two-letter state code from the nation key: AA, AB, … EE."""
    return F.concat(F.call_function("chr", F.lit(65) + F.floor(nationkey / 5)),
                    F.call_function("chr", F.lit(65) + nationkey % 5))


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def customers_extract(spark: SparkSession, sf_dir: str,
                      cfg: RunConfig = DEFAULT) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        _text(k).alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lit("555-"), _pad(k % 10000, 4)).alias("phone"),
        _day_text(date(1925, 1, 1), (k * 101) % 21184).alias("date_of_birth"),
        _pad((k * 7) % 10000, 4).alias("ssn_last4"),
        F.concat(_text(k % 997 + 1), F.lit(" Main St")).alias("address_line1"),
        F.concat(F.lit("City_"), _text(F.col("c_nationkey"))).alias("city"),
        _state_code(F.col("n_nationkey")).alias("state"),
        _pad((k * 31) % 100000, 5).alias("zip_code"),
        F.lit("US").alias("country"),
        case_map(F.col("c_mktsegment"), MKT_SEGMENT_TO_SEGMENT).alias("segment"),
        (F.lit(580) + (k * 37) % 271).alias("credit_score"),
        (F.lit(30000) + (k * 7919) % 470001).alias("annual_income"),
        F.when(k % 100 < 88, "Verified").when(k % 100 < 97, "Pending")
         .otherwise("Failed").alias("kyc_status"),
        (k % 50 == 0).alias("is_pep"),
        pick(D.CHANNELS, k % 6).alias("preferred_channel"),
        _day_text(date(1990, 1, 1), (k * 53) % 1800).alias("customer_since"),
        F.lit("CRM").alias("source_system"),
        _run_ts(cfg).alias("record_created_at"),
    )
    return _conform(df, schemas.CUSTOMERS)


def accounts_extract(spark: SparkSession, sf_dir: str,
                     cfg: RunConfig = DEFAULT) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    product = pick(D.PRODUCTS, k % 8)
    status = (F.when(k % 100 < 80, "Active").when(k % 100 < 88, "Dormant")
              .when(k % 100 < 97, "Closed").otherwise("Suspended"))
    opened = F.to_date(F.col("o_orderdate"))
    day = lambda off: F.date_format(F.date_add(opened, off.cast("int")), "yyyy-MM-dd")
    balance = F.floor(F.col("o_totalprice") * F.lit(5.0)).cast("double") / F.lit(100.0)
    df = o.select(
        _text(k).alias("account_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        _pad(k, 10).alias("account_number"),
        product.alias("product_type"),
        status.alias("account_status"),
        F.date_format(opened, "yyyy-MM-dd").alias("open_date"),
        F.when(status == "Closed", day(k % 365)).alias("close_date"),
        balance.alias("balance"),
        (balance * F.lit(0.85)).alias("available_balance"),
        F.when(product.isin("Credit Card", "HELOC"),
               (F.lit(1000) + (k * 13) % 49001).cast("double")).alias("credit_limit"),
        ((k % 180).cast("double") / F.lit(1000.0)).alias("interest_rate"),
        _text(k % BRANCH_CODE_SPACE).alias("branch_code"),
        F.lit("USD").alias("currency"),
        (k % 3 == 0).alias("overdraft_protection"),
        (k % 2 == 0).alias("paperless_enrolled"),
        day(k % 200).alias("last_activity_date"),
        F.lit("Core Banking").alias("source_system"),
        _run_ts(cfg).alias("record_created_at"),
    )
    return _conform(df, schemas.ACCOUNTS)


def transactions_extract(spark: SparkSession, sf_dir: str,
                         cfg: RunConfig = DEFAULT) -> DataFrame:
    """Line items as transactions; ``transaction_id`` repeats (a natural
    de-duplication input) and one orphan appears at larger scales."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    debit = F.col("l_linestatus") == "F"
    ttype = F.when(debit, pick(D.DEBIT_TXN_TYPES, F.col("l_partkey") % 6)) \
             .otherwise(pick(D.CREDIT_TXN_TYPES, F.col("l_partkey") % 3))
    shipped = F.to_date(F.col("l_shipdate"))
    purchase = ttype == "Purchase"
    df = li.join(o, li.l_orderkey == o.o_orderkey, "left").select(
        F.concat(_text(F.col("l_orderkey")), F.lit("-"),
                 _text(F.col("l_linenumber"))).alias("transaction_id"),
        _text(F.col("l_orderkey")).alias("account_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        ttype.alias("transaction_type"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(debit, "Debit").otherwise("Credit").alias("direction"),
        pick(D.CHANNELS, F.col("l_suppkey") % 6).alias("channel"),
        F.when(purchase, F.concat(F.lit("Merchant_"),
                                  _text(F.col("l_suppkey") % 200 + 1))).alias("merchant_name"),
        F.when(purchase, pick(D.MERCHANT_CATEGORIES, F.col("l_partkey") % 7))
         .alias("merchant_category"),
        F.date_format(shipped, "yyyy-MM-dd").alias("transaction_date"),
        F.concat(_pad(F.col("l_linenumber"), 2), F.lit(":"),
                 _pad(F.round(F.col("l_tax") * F.lit(100.0)).cast("int"), 2),
                 F.lit(":00")).alias("transaction_time"),
        F.date_format(F.date_add(shipped, (F.col("l_partkey") % 3).cast("int")),
                      "yyyy-MM-dd").alias("posting_date"),
        (F.col("l_quantity") * F.lit(1000.0)).alias("balance_after"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).alias("is_flagged"),
        (F.col("l_discount") * F.lit(10.0)).alias("fraud_score"),
        F.concat(F.lit("REF"), _text(F.col("l_partkey")), F.lit("-"),
                 _text(F.col("l_suppkey"))).alias("reference_number"),
        F.concat(ttype, F.lit(" line "), _text(F.col("l_linenumber"))).alias("description"),
        F.lit("Transaction Processing").alias("source_system"),
        _run_ts(cfg).alias("record_created_at"),
    )
    return _conform(df, schemas.TRANSACTIONS)


# tie-break for duplicated transaction ids (makes the dedup order total)
TRANSACTION_TIE_BREAK = [("transaction_date", "desc"), ("reference_number", "asc"),
                         ("amount", "asc"), ("balance_after", "asc"),
                         ("fraud_score", "asc"), ("transaction_time", "asc")]


def tickets_extract(spark: SparkSession, sf_dir: str,
                    cfg: RunConfig = DEFAULT) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    status = pick(D.TICKET_STATUSES, F.floor(k / 100) % 5)
    resolved = status.isin(*D.RESOLVED_STATUSES)
    created = F.to_date(F.col("ts"))
    csat_bucket = F.floor(k / 10) % 10
    csat = (F.when(csat_bucket == 0, 1).when(csat_bucket == 1, 2)
            .when(csat_bucket == 2, 3).when(csat_bucket <= 5, 4).otherwise(5))
    prio_bucket = F.floor(k / 3) % 20
    priority = (F.when(prio_bucket < 7, "Low").when(prio_bucket < 15, "Medium")
                .when(prio_bucket < 19, "High").otherwise("Critical"))
    df = e.select(
        _text(k).alias("ticket_id"),
        _text(F.col("user_id") * 10 + k % 10).alias("customer_id"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("Sub_"), _text(k % 5 + 1)).alias("sub_category"),
        pick(D.CHANNELS, k % 6).alias("channel"),
        priority.alias("priority"),
        status.alias("status"),
        F.date_format(created, "yyyy-MM-dd").alias("created_date"),
        F.date_format(F.col("ts"), "HH:mm:ss").alias("created_time"),
        F.when(resolved, F.date_format(F.date_add(created, (k % 14 + 1).cast("int")),
                                       "yyyy-MM-dd")).alias("resolved_date"),
        F.when(resolved, pick(D.RESOLUTIONS, k % 6)).alias("resolution"),
        F.concat(F.lit("AGENT"), _text(k % 100 + 100)).alias("agent_id"),
        F.when(k % 4 == 0, _text(k % BRANCH_CODE_SPACE)).alias("branch_id"),
        F.when(resolved, csat).alias("csat_score"),
        (F.floor(k / 7) % 12 == 0).alias("is_escalated"),
        F.concat(F.lit("Ticket "), _text(k)).alias("notes"),
        F.lit("CRM").alias("source_system"),
        _run_ts(cfg).alias("record_created_at"),
    )
    return _conform(df, schemas.TICKETS)


def branches_extract(spark: SparkSession, sf_dir: str,
                     cfg: RunConfig = DEFAULT) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    df = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        _text(k).alias("branch_id"),
        F.col("s_name").alias("branch_name"),
        pick(D.BRANCH_TYPES, k % 3).alias("branch_type"),
        F.concat(_text(k % 997 + 1), F.lit(" Commerce St")).alias("address"),
        F.concat(F.lit("City_"), _text(F.col("s_nationkey"))).alias("city"),
        _state_code(F.col("n_nationkey")).alias("state"),
        _pad((k * 17) % 100000, 5).alias("zip_code"),
        F.concat(F.lit("555-"), _pad(k % 10000, 4)).alias("phone"),
        F.concat(F.lit("Manager_"), _text(k)).alias("manager_name"),
        _day_text(date(1980, 1, 1), (k * 17) % 10000).alias("open_date"),
        (k % 14 != 0).alias("is_active"),
        (F.lit(1) + k % 6).alias("atm_count"),
        (F.lit(1000) + (k * 37) % 7001).alias("sq_footage"),
        _run_ts(cfg).alias("record_created_at"),
    )
    return _conform(df, schemas.BRANCHES)


def segment_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment changes of customers: (customer_id, segment, effective date, sequence).
    Orders stand for profile updates; the order priority stands for the segment,
    the order key orders same-day updates."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        _text(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("segment"),
        F.to_date(F.col("o_orderdate")).alias("effective_date"),
        F.col("o_orderkey").alias("seq"),
    )


def customer_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer attribute change log: customer_id, the eight tracked attributes,
    effective date and sequence, like :func:`segment_change_log`.  Every attribute is
    NULL in some updates, so it changes to and from NULL.
    """
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def known(every: int, value: Column) -> Column:
        return F.when(k % every != 0, value)

    return o.select(
        _text(F.col("o_custkey")).alias("customer_id"),
        known(11, F.col("o_orderpriority")).alias("segment"),
        known(13, (F.lit(600) + k % 3 * 50).cast("int")).alias("credit_score"),
        known(17, (F.lit(40000) + F.floor(k / 4) % 2 * 25000).cast("double")).alias("annual_income"),
        known(19, pick(D.KYC_STATUSES, F.floor(k / 5) % 3)).alias("kyc_status"),
        known(23, F.concat(_text(k % 2 + 1), F.lit(" Main St"))).alias("address_line1"),
        known(29, F.concat(F.lit("City_"), _text(F.floor(k / 8) % 3))).alias("city"),
        known(31, _state_code(F.floor(k / 16) % 2)).alias("state"),
        known(37, _pad(F.floor(k / 32) % 2 * 31, 5)).alias("zip_code"),
        F.to_date(F.col("o_orderdate")).alias("effective_date"),
        F.col("o_orderkey").alias("seq"),
    )
