"""Plan-shape tests: the physical plans we want at scale."""

import __spark_entry__ as E
from bankmart.plans import catalogue
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_query(spark):
    qs = catalogue.queries()
    skip = {"csv_scan", "ingest_ledger", "csv_quarantine", "schema_evolve", "bronze_append", "full_refresh", "partitioned_overwrite", "scd2_apply",
            "dq_audit_append", "clustered_rewrite", "compact_files", "file_stats",
            "serving_load", "serving_rejects", "serving_ledger", "snapshot_as_of", "registered_tables", "partition_values", "partition_pruned_count"}
    for key, fn in qs.items():
        if key in skip:
            continue
        p = _plan(fn(spark, SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
            assert node not in p, key


def test_dedup_uses_window_group_limit(spark):
    df = E.queries()["dedup_latest"](spark, SMALL)
    df._jdf.queryExecution().executedPlan()  # force planning
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_join_is_broadcast(spark):
    p = _plan(E.queries()["broadcast_lookup"](spark, SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scan_is_pruned(spark):
    """Column pruning reaches the Parquet scans: the customer scan under the
    geography query never reads the unused account-balance column."""
    p = _plan(E.queries()["q5_geography"](spark, SMALL))
    scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "c_custkey" in ln]
    assert scans and all("c_acctbal" not in ln for ln in scans)
    branch_scans = [ln for ln in _plan(E.queries()["silver_branches"](spark, SMALL)).splitlines()
                    if "FileScan parquet" in ln and "s_suppkey" in ln]
    assert branch_scans and all("s_acctbal" not in ln for ln in branch_scans)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert len(df.columns) == 43


def test_sql_string_and_column_filters_plan_the_same(spark):
    from pyspark.sql import functions as F
    from bankmart.operators import layout
    from bankmart.session import scratch_path
    path = scratch_path(spark, "same-plan")
    layout.write_partitioned(spark.range(50).selectExpr("id", "cast(id % 5 as int) as y",
                                                        "cast(id % 3 as int) as m"), path, ["y", "m"])
    t = spark.read.parquet(path)
    a = t.where((F.col("y") == 2) & (F.col("m") == 1))
    b = t.where("y = 2 AND m = 1")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(a).split("\n")[0] == plan(b).split("\n")[0]
    assert a.count() == b.count()


def test_clustered_rewrite_colocates_segments(spark, lake):
    from pyspark.sql import functions as F
    from bankmart.operators import layout
    from bankmart.session import scratch_path
    path = scratch_path(spark, "clustered-test")
    layout.clustered_rewrite(lake.customer_360, path, ["segment", "state"], ["customer_id"], partitions=8)
    per_file = (spark.read.parquet(path).groupBy(F.col("_metadata.file_name"))
                .agg(F.countDistinct("segment").alias("n")))
    # 5 segments over 8 range partitions: no file spans more than 2 segments
    assert per_file.agg(F.max("n")).first()[0] <= 2


def test_cli_lists_every_key(capsys):
    from bankmart.__main__ import main
    main(["list"])
    keys = capsys.readouterr().out.split()
    assert len(keys) == 102 and "customer_360" in keys and "scd2_apply" in keys
