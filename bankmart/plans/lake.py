"""The medallion lake as lazily composed DataFrames.

``Lake(spark, sf_dir, cfg)`` exposes every layer as a DataFrame property.
Nothing runs until an action; Catalyst prunes what a query does not read.
``Lake.materialized(...)`` swaps the Silver and Gold layers for tables
written once to the shared folder and read back, which is how the daily
daily batch and the benchmark use it (each mart is computed once, queries
scan Parquet instead of re-deriving the lineage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart import schemas
from bankmart.config import RunConfig, DEFAULT
from bankmart.operators import bronze, gold, silver
from bankmart.sources import adapters, csv


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig = DEFAULT,
                 landing: str | None = None, declared: dict[str, dict[str, str]] | None = None):
        """Sources are the test tables of ``sf_dir``, or CSV drops ``<landing>/<source>/``;
        ``declared`` has the types of columns new to a source."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.landing = landing
        self.declared = declared or {}
        self._tables: dict[str, DataFrame] = {}
        self.paths: dict[str, str] = {}            # folders of written tables
        self._own: set[str] = set()                # those that written_once wrote for this lake

    # ── sources and Bronze ──────────────────────────────────────────────────
    EXTRACTS = {"customers": adapters.customers_extract,
                "accounts": adapters.accounts_extract,
                "transactions": adapters.transactions_extract,
                "branches": adapters.branches_extract,
                "support_tickets": adapters.tickets_extract}

    def extract(self, name: str) -> DataFrame:
        """One source extract, built on first use (a query reading one
        table does not touch the others' files).  Rows of a CSV drop carry
        ``_corrupt_record`` and ``_input``."""
        if self.landing is not None:
            return self._get(f"extract:{name}", lambda: csv.read_drop(
                self.spark, f"{self.landing}/{name}", schemas.SOURCES[name], self.declared.get(name)))
        return self._get(f"extract:{name}",
                         lambda: self.EXTRACTS[name](self.spark, self.sf_dir, self.cfg))

    def bronze(self, name: str) -> DataFrame:
        system = schemas.SOURCE_META[name][0]
        return bronze.stamp(self.extract(name), system, f"{name}.csv", self.cfg)

    # ── Silver ──────────────────────────────────────────────────────────────
    def _get(self, name, build):
        if name not in self._tables:
            self._tables[name] = build()
        return self._tables[name]

    @property
    def silver_customers(self) -> DataFrame:
        return self._get("silver_customers",
                         lambda: silver.silver_customers(self.bronze("customers"), self.cfg))

    @property
    def silver_accounts(self) -> DataFrame:
        return self._get("silver_accounts",
                         lambda: silver.silver_accounts(self.bronze("accounts"), self.cfg))

    @property
    def silver_transactions(self) -> DataFrame:
        return self._get("silver_transactions",
                         lambda: silver.silver_transactions(self.bronze("transactions"), self.cfg))

    @property
    def silver_branches(self) -> DataFrame:
        return self._get("silver_branches",
                         lambda: silver.silver_branches(self.bronze("branches"), self.cfg))

    @property
    def silver_tickets(self) -> DataFrame:
        return self._get("silver_tickets",
                         lambda: silver.silver_tickets(self.bronze("support_tickets"), self.cfg))

    # ── Gold ────────────────────────────────────────────────────────────────
    @property
    def customer_360(self) -> DataFrame:
        return self._get("customer_360", lambda: gold.customer_360(
            self.silver_customers, self.silver_accounts, self.silver_transactions,
            self.silver_tickets, self.cfg, self._tables.get("transaction_months")))

    @property
    def txn_monthly_summary(self) -> DataFrame:
        return self._get("txn_monthly_summary", lambda: gold.txn_monthly_summary(self.silver_transactions))

    @property
    def segment_metrics(self) -> DataFrame:
        return self._get("segment_metrics",
                         lambda: gold.segment_metrics(self.customer_360, self.cfg))

    @property
    def support_kpis(self) -> DataFrame:
        return self._get("support_kpis",
                         lambda: gold.support_kpis(self.silver_tickets, self.cfg))

    @property
    def dq_results(self) -> DataFrame:
        from bankmart.operators import quality
        return self._get("dq_results", lambda: quality.run_suites(self, self.cfg))

    # ── materialisation ─────────────────────────────────────────────────────
    SILVER = ["silver_customers", "silver_accounts", "silver_transactions",
              "silver_branches", "silver_tickets"]
    SILVER_FACTS = ["silver_customers", "silver_accounts", "silver_transactions", "silver_tickets"]
    GOLD = ["customer_360", "txn_monthly_summary", "segment_metrics", "support_kpis"]

    # Silver tables that batches are merged into: source, key, partition columns
    MERGED = {"silver_accounts": ("accounts", "account_id", ["product_type"]),
              "silver_transactions": ("transactions", "transaction_id", ["txn_year", "txn_month"]),
              "silver_tickets": ("support_tickets", "ticket_id", ["created_month"])}

    # tables written partitioned: name → partition columns
    PARTITIONED = {**{name: by for name, (_, _, by) in MERGED.items()},
                   "customer_360": ["segment"], "txn_monthly_summary": ["txn_year", "txn_month"],
                   "support_kpis": ["created_month"]}

    @staticmethod
    def clean(name: str, bronze_rows: DataFrame, cfg: RunConfig) -> DataFrame:
        """Stored form of a merged Silver table: nothing in it depends on the run's date."""
        build = {"silver_accounts": silver.clean_accounts, "silver_transactions": silver.silver_transactions,
                 "silver_tickets": silver.silver_tickets}[name]
        return Lake.stored(name, build(bronze_rows, cfg))

    @staticmethod
    def stored(name: str, rows: DataFrame) -> DataFrame:
        """``rows`` with the table's partition columns."""
        if "created_month" in Lake.PARTITIONED.get(name, ()):
            rows = rows.withColumn("created_month", F.date_format("created_date", "yyyy-MM"))
        return rows

    @staticmethod
    def shown(name: str, rows: DataFrame, cfg: RunConfig) -> DataFrame:
        """A stored table as queries see it."""
        if name == "silver_accounts" and "account_age_days" not in rows.columns:
            rows = silver.aged_accounts(rows, cfg)
        return rows.drop("created_month", *gold.MONTH_PARTIALS)

    # tables whose rows are shuffled whole (or nearly) by a key: the key that deals them into slices
    SLICED = {"silver_accounts": "account_id", "silver_transactions": "transaction_id",
              "silver_tickets": "ticket_id", "txn_monthly_summary": "customer_id"}
    SLICES = 3                              # fixed, so the scans grow with the input only

    def _slices(self, df: DataFrame, name: str) -> list[DataFrame]:
        """``df`` in parts of whole keys (NULL is one of them), to be written one after the
        other: all their shuffle files together are on disk only for one part.  The filter
        goes below the joins, the deduplication and the aggregation; every part scans the input."""
        from bankmart.session import is_large
        key = self.SLICED.get(name)
        if key is None or not is_large(df):
            return [df]
        dealt = F.pmod(F.xxhash64(key), F.lit(self.SLICES))
        return [df.where(dealt == i) for i in range(self.SLICES)]

    def _write(self, df: DataFrame, name: str, path: str, plain: bool = False) -> None:
        if plain:
            for i, part in enumerate(self._slices(df, name)):
                part.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(path)
        elif name in self.PARTITIONED:
            from bankmart.operators.layout import write_partitioned_balanced
            write_partitioned_balanced(df, path, self.PARTITIONED[name])
        else:
            df.write.mode("overwrite").parquet(path)

    def _stored_form(self, name: str) -> DataFrame:
        """What is written of a table.  The monthly mart keeps its partial measures, which
        the customer KPIs roll up; transactions are aggregated once."""
        if name == "txn_monthly_summary":
            txns = self.silver_transactions
            return gold.transaction_months(txns, gold.only_known_channels(txns))
        return self.stored(name, getattr(self, name))

    def write_concurrently(self, root: str, names, plain: bool = False,
                           columns: dict[str, list[str]] | None = None) -> None:
        """Write independent tables as concurrent Spark jobs (one driver
        thread each), so small or single-task stages of one table overlap
        with the others instead of leaving executors idle.  ``plain`` writes them as they
        come, without the shuffle into partitions; ``columns`` has the columns kept of
        some tables."""
        from bankmart.session import run_concurrently
        builds = {n: self._stored_form(n) for n in names}      # plan on this thread
        builds.update({n: builds[n].select(*kept) for n, kept in (columns or {}).items() if n in builds})
        run_concurrently([(lambda n=n: self._write(builds[n], n, f"{root}/{n}", plain))
                          for n in builds])
        for n in names:
            self.paths[n] = f"{root}/{n}"
            written = self.spark.read.schema(builds[n].schema).parquet(self.paths[n])
            self._tables[n] = self.shown(n, written, self.cfg)
            if n == "txn_monthly_summary":
                self._tables["transaction_months"] = written

    # dependency order of the daily build: each group only reads earlier ones
    BUILD_ORDER = [SILVER, ["txn_monthly_summary", "dq_results", "support_kpis"],
                   ["customer_360"], ["segment_metrics"]]

    # what the marts and the audit read of the widest table
    GOLD_READS = {"silver_transactions": ["transaction_id", "account_id", "customer_id", "transaction_date", "amount",
                                          "direction", "channel", "is_flagged", "fraud_score"]}

    def written_once(self, names, columns: dict[str, list[str]] | None = None) -> "Lake":
        """A lake over the same sources whose tables ``names`` are written once to the shared
        folder in build order, as they come; tables that this one has written are kept.
        For jobs that read a table several times: its marts' lineage runs once.  Shuffle
        files of a write, or of a large table's slice, are gone before the next one."""
        from bankmart.session import scratch_path, shuffles_freed
        missing = [n for n in names if n not in self.paths]
        if not missing:
            return self
        lake = Lake(self.spark, self.sf_dir, self.cfg, self.landing, self.declared)
        lake.paths = dict(self.paths)
        # unwritten tables are planned again, on top of the written ones
        lake._tables = {n: t for n, t in self._tables.items() if self.paths or n.startswith("extract:")}
        root = scratch_path(self.spark, "lake")
        with shuffles_freed(self.spark):
            for group in self.BUILD_ORDER:
                lake.write_concurrently(root, [n for n in group if n in missing], True, columns)
        lake._own = set(missing)
        return lake

    def drop_written(self, names) -> None:
        """Delete those of the tables that :meth:`written_once` wrote for this lake, after
        their last reader; tables of another lake or of a warehouse are kept."""
        from bankmart.session import delete_folder
        for n in self._own.intersection(names):
            self._own.remove(n)
            self._tables.pop(n, None)
            if n == "txn_monthly_summary":
                self._tables.pop("transaction_months", None)
            delete_folder(self.spark, self.paths.pop(n))

    @classmethod
    def from_warehouse(cls, spark, warehouse: str, cfg: RunConfig = DEFAULT,
                       sf_dir: str | None = None) -> "Lake":
        """A lake whose Silver, Gold and audit layers are the tables a daily
        batch wrote under ``warehouse`` (queries scan them; nothing is
        re-derived).  ``sf_dir`` is only needed by queries that read raw
        sources (Bronze-level and change-log keys)."""
        from bankmart.operators import quality, scd2
        lake = cls(spark, sf_dir, cfg)
        store = f"{warehouse}/silver/customers_scd2"
        lake._tables["silver_customers"] = scd2.store_read(
            spark, store, scd2.store_schema(spark, store))
        lake.paths = {**{n: f"{warehouse}/silver/{n}" for n in cls.SILVER[1:]},
                      **{n: f"{warehouse}/gold/{n}" for n in cls.GOLD}}
        for name, path in lake.paths.items():
            lake._tables[name] = cls.shown(name, spark.read.parquet(path), cfg)
        lake._tables["dq_results"] = quality.read_audit(spark, f"{warehouse}/audit/dq_results")
        return lake

    @classmethod
    def materialized(cls, spark, sf_dir, root, cfg: RunConfig = DEFAULT) -> "Lake":
        """Silver, then its DQ audit and the monthly mart, then Customer 360, which rolls
        the monthly mart up, then the segment roll-up of the written Customer 360."""
        lake = cls(spark, sf_dir, cfg)
        for group in cls.BUILD_ORDER:
            lake.write_concurrently(root, group)
        return lake
