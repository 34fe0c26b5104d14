"""Declarative data-quality rules compiled into one aggregate per table.

A suite of column rules over one table becomes a single ``agg`` (one scan,
one partial/final aggregation) instead of two Spark jobs per rule; the one
aggregated row is turned into one result row per rule with ``explode``.
Referential-integrity rules pre-aggregate the child keys (a hot key becomes
one row per map task) before meeting the parent's distinct keys.  Nothing
is collected except by :func:`enforce_gate`, which reads one aggregated
row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart import domains as D
from bankmart.config import RunConfig, DEFAULT


class DataQualityError(RuntimeError):
    """Raised by the gate when a failing check blocks promotion."""


def _num(v) -> str:
    return repr(v) if isinstance(v, float) else str(v)


@dataclass(frozen=True)
class NotNull:
    column: str
    tolerance_pct: float = 0.0
    kind = "not_null"

    @property
    def check_name(self): return f"not_null_{self.column}"

    @property
    def rule(self): return f"{self.column} IS NOT NULL (tolerance {_num(float(self.tolerance_pct))}%)"

    def failing(self) -> Column:
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class Unique:
    """Failing = rows − distinct values, NULL counting as one value."""
    column: str
    tolerance_pct: float | None = None
    kind = "unique"

    @property
    def check_name(self): return f"unique_{self.column}"

    @property
    def rule(self): return f"{self.column} must be unique"

    def failing(self) -> Column:
        c = F.col(self.column)
        return (F.count(F.lit(1)) - F.countDistinct(c)
                - F.coalesce(F.max(c.isNull().cast("int")), F.lit(0)).cast("long"))


@dataclass(frozen=True)
class InSet:
    """Values outside the set fail; NULL does not (``NOT IN`` is NULL)."""
    column: str
    values: tuple
    tolerance_pct: float | None = None
    kind = "value_set"

    @property
    def check_name(self): return f"value_set_{self.column}"

    @property
    def rule(self): return f"{self.column} IN {list(self.values)}"

    def failing(self) -> Column:
        return F.count_if(~F.col(self.column).isin(*self.values))


@dataclass(frozen=True)
class InRange:
    """Non-null values below ``low`` or above ``high`` fail."""
    column: str
    low: float
    high: float
    tolerance_pct: float = 0.0
    kind = "range"

    @property
    def check_name(self): return f"range_{self.column}"

    @property
    def rule(self): return f"{_num(self.low)} <= {self.column} <= {_num(self.high)}"

    def failing(self) -> Column:
        c = F.col(self.column)
        return F.count_if(c.isNotNull() & ((c < F.lit(self.low)) | (c > F.lit(self.high))))


@dataclass(frozen=True)
class References:
    """Every child key must exist in the parent; a NULL key fails."""
    column: str
    parent: str
    parent_column: str
    tolerance_pct: float | None = None
    kind = "ri"


@dataclass
class Suite:
    table: str                       # audit name, e.g. "silver.accounts"
    rules: Sequence = field(default_factory=list)

    def column_rules(self):
        return [r for r in self.rules if not isinstance(r, References)]

    def ri_rules(self):
        return [r for r in self.rules if isinstance(r, References)]


def _fused_counts(df: DataFrame, suite: Suite) -> DataFrame:
    rules = suite.column_rules()
    if not rules:
        return None
    agg = df.agg(F.count(F.lit(1)).alias("total_count"),
                 *[r.failing().cast("long").alias(f"_f{i}") for i, r in enumerate(rules)])
    entries = [F.struct(F.lit(r.check_name).alias("check_name"),
                        F.lit(r.rule).alias("rule"),
                        F.lit(r.tolerance_pct).cast("double").alias("tolerance_pct"),
                        F.col(f"_f{i}").alias("failing_count"))
               for i, r in enumerate(rules)]
    return (agg.select("total_count", F.explode(F.array(*entries)).alias("r"))
               .select(F.lit(suite.table).alias("table_name"), "r.check_name", "r.rule",
                       "r.tolerance_pct", "r.failing_count", "total_count"))


def _ri_counts(child: DataFrame, parent: DataFrame, suite: Suite, r: References) -> DataFrame:
    keys = child.groupBy(F.col(r.column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(r.parent_column).alias("_p")).distinct()
    joined = keys.join(parents, keys._k == parents._p, "left")
    return joined.agg(
        F.lit(suite.table).alias("table_name"),
        F.lit(f"ri_{suite.table}_{r.column}").alias("check_name"),
        F.lit(f"{suite.table}.{r.column} EXISTS IN {r.parent}.{r.parent_column}").alias("rule"),
        F.lit(None).cast("double").alias("tolerance_pct"),
        F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("_n"))), F.lit(0)).cast("long")
         .alias("failing_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_count"))


def run_suite(df: DataFrame, suite: Suite, parents: dict[str, DataFrame] | None = None,
              cfg: RunConfig = DEFAULT) -> DataFrame:
    """Result rows (audit schema) of one suite; lazy."""
    return results(suite_counts(df, suite, parents), cfg)


def suite_counts(df: DataFrame, suite: Suite, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Failing and total counts of one suite's rules; lazy."""
    parts = []
    fused = _fused_counts(df, suite)
    if fused is not None:
        parts.append(fused)
    for r in suite.ri_rules():
        parts.append(_ri_counts(df, (parents or {})[r.parent], suite, r))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def results(counts: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """Counts → audit rows: status, pass % (2 places; 100 when empty)."""
    total, failing, tol = F.col("total_count"), F.col("failing_count"), F.col("tolerance_pct")
    passed = (F.when(total == 0, True)
               .when(tol.isNotNull(), failing / total * 100 <= tol)
               .otherwise(failing == 0))
    pct = F.when(total > 0, F.round((1 - failing / total) * 100, 2)).otherwise(F.lit(100.0))
    return counts.select(
        F.lit(cfg.batch_id).alias("batch_id"),
        F.lit(cfg.run_ts.isoformat()).alias("run_ts"),
        "table_name", "check_name", "rule",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        failing.alias("failing_count"), total.alias("total_count"),
        pct.alias("pass_pct"))


# ── the four production suites ──────────────────────────────────────────────
CUSTOMERS = Suite("silver.customers", [
    NotNull("customer_id"), NotNull("email", 1.0), NotNull("segment"), NotNull("kyc_status"),
    Unique("customer_id"),
    InSet("segment", tuple(D.SEGMENTS)), InSet("kyc_status", tuple(D.KYC_STATUSES)),
    InRange("credit_score", 300, 850, 0.5), InRange("annual_income", 0, 10_000_000),
    InRange("age", 18, 120, 1.0)])

ACCOUNTS = Suite("silver.accounts", [
    NotNull("account_id"), NotNull("customer_id"), NotNull("product_type"),
    Unique("account_id"), InSet("account_status", tuple(D.ACCOUNT_STATUSES)),
    InRange("balance", 0, 50_000_000),
    References("customer_id", "silver.customers", "customer_id")])

TRANSACTIONS = Suite("silver.transactions", [
    NotNull("transaction_id"), NotNull("account_id"), NotNull("amount"),
    NotNull("transaction_date"), Unique("transaction_id"),
    InRange("amount", 0.01, 10_000_000, 0.1), InRange("fraud_score", 0.0, 1.0),
    InSet("direction", tuple(D.DIRECTIONS)),
    References("account_id", "silver.accounts", "account_id")])

TICKETS = Suite("silver.support_tickets", [
    NotNull("ticket_id"), NotNull("customer_id"), NotNull("category"),
    Unique("ticket_id"), InRange("csat_score", 1, 5, 5.0),
    InSet("priority", tuple(D.PRIORITIES))])

SUITES = {"customers": CUSTOMERS, "accounts": ACCOUNTS,
          "transactions": TRANSACTIONS, "tickets": TICKETS}


def suite_inputs(lake) -> dict[str, DataFrame]:
    cust = lake.silver_customers.where(F.col("scd_is_current"))
    return {"customers": cust, "accounts": lake.silver_accounts,
            "transactions": lake.silver_transactions, "tickets": lake.silver_tickets}


def parent_tables(lake) -> dict[str, DataFrame]:
    return {"silver.customers": lake.silver_customers.where(F.col("scd_is_current")),
            "silver.accounts": lake.silver_accounts}


def run_named_suite(lake, name: str, cfg: RunConfig = DEFAULT) -> DataFrame:
    return run_suite(suite_inputs(lake)[name], SUITES[name], parent_tables(lake), cfg)


def all_counts(lake) -> DataFrame:
    """Counts of all suites, which :func:`results` makes into audit rows of any run."""
    inputs, parents, out = suite_inputs(lake), parent_tables(lake), None
    for name, suite in SUITES.items():
        part = suite_counts(inputs[name], suite, parents)
        out = part if out is None else out.unionByName(part)
    return out


def run_suites(lake, cfg: RunConfig = DEFAULT) -> DataFrame:
    out = None
    for name in SUITES:
        part = run_named_suite(lake, name, cfg)
        out = part if out is None else out.unionByName(part)
    return out


def summary(dq: DataFrame) -> DataFrame:
    return dq.groupBy("status").agg(F.count(F.lit(1)).alias("check_count"))


def failed_checks(dq: DataFrame) -> DataFrame:
    return dq.where(F.col("status") == "FAIL").select("table_name", "check_name", "failing_count", "total_count")


def gate(dq: DataFrame, cfg: RunConfig = DEFAULT) -> DataFrame:
    """One row: pass/fail counts and whether Gold may be promoted
    (promote ⇔ no failure OR the run does not abort on failures)."""
    fail = F.count_if(F.col("status") == "FAIL")
    return dq.agg(F.count_if(F.col("status") == "PASS").alias("pass_count"),
                  fail.alias("fail_count"),
                  ((fail == 0) | F.lit(not cfg.abort_on_failure)).alias("promote"))


def enforce_gate(dq: DataFrame, cfg: RunConfig = DEFAULT) -> dict:
    """Driver-side decision from one aggregated row; raises to block Gold."""
    row = gate(dq, cfg).first()
    if not row["promote"]:
        failed = [r["check_name"] for r in
                  dq.where(F.col("status") == "FAIL").select("check_name").collect()]
        raise DataQualityError(
            f"Data quality check failed — {row['fail_count']} rules violated: {failed}")
    return row.asDict()


def run_kind(lake, kind, cfg: RunConfig = DEFAULT) -> DataFrame:
    """All rules of one kind (e.g. :class:`NotNull`) across the suites."""
    inputs, parents, out = suite_inputs(lake), parent_tables(lake), None
    for name, suite in SUITES.items():
        rules = [r for r in suite.rules if isinstance(r, kind)]
        if not rules:
            continue
        part = run_suite(inputs[name], Suite(suite.table, rules), parents, cfg)
        out = part if out is None else out.unionByName(part)
    return out


def append_audit(dq: DataFrame, path: str) -> None:
    """Append a run's results to the audit table, partitioned by batch id;
    a rerun of the same batch replaces its own rows (dynamic overwrite)."""
    (dq.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def read_audit(spark, path: str) -> DataFrame:
    from bankmart.schemas import DQ_RESULTS
    return spark.read.schema(DQ_RESULTS).parquet(path)
