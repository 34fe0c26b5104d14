import glob
from datetime import date

from pyspark.sql import functions as F

import pytest

from bankmart import session
from bankmart.config import RunConfig
from bankmart.operators import bronze, layout, scd2
from bankmart.plans import daily, dashboard, jobs


def test_undated_rows_share_one_month(spark):
    rows = [("2001-02-03",), (None,), ("bad",), ("2001-02-31",), ("",)]
    df = spark.createDataFrame(rows, "d string").select(bronze.month_key("d").alias("m"))
    assert [r.m for r in df.collect()] == ["2001-02", "unknown", "unknown", "unknown", "unknown"]


def test_undated_batches_stay_side_by_side(spark, tmp_path):
    path = str(tmp_path / "b")
    for batch, dates in (("1", [None, "bad"]), ("2", ["worse", "2001-01-01"])):
        df = spark.createDataFrame([(d,) for d in dates], "d string")
        bronze.append(df, path, batch, business_date="d")
    assert spark.read.parquet(path).count() == 4
    assert spark.read.parquet(path).where("_month = 'unknown'").count() == 3


def test_rerun_replaces_the_whole_batch(spark, tmp_path):
    path = str(tmp_path / "b")
    for dates in (["2001-01-01", "2001-02-01", None], ["2001-02-05"]):
        bronze.append(spark.createDataFrame([(d,) for d in dates], "d string"), path, "1", business_date="d")
    assert [r.d for r in spark.read.parquet(path).collect()] == ["2001-02-05"]


def _txn(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, amount double, txn_year int, txn_month int")


def test_merge_moves_dates_and_drops_empty_months(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.write_partitioned_balanced(_txn(spark, [
        ("a", 1.0, 2001, 1), ("b", 2.0, 2001, 2), ("c", 3.0, None, None), ("d", 4.0, 2001, 3),
        ("e", 5.0, 2001, 3)]), path, daily.MONTH)
    untouched = sorted(glob.glob(f"{path}/txn_year=2001/txn_month=3/*.parquet"))
    daily.merge_transactions(spark, path, _txn(spark, [
        ("a", 1.5, 2001, 2), ("c", 3.5, 2001, 4), ("f", 6.0, None, None), (None, 7.0, 2001, 2)]))
    schema = _txn(spark, []).schema
    got = {tuple(r) for r in spark.read.schema(schema).parquet(path)
           .select("transaction_id", "amount", "txn_year", "txn_month").collect()}
    assert got == {("a", 1.5, 2001, 2), ("b", 2.0, 2001, 2), ("c", 3.5, 2001, 4), ("d", 4.0, 2001, 3),
                   ("e", 5.0, 2001, 3), ("f", 6.0, None, None), (None, 7.0, 2001, 2)}
    assert sorted(glob.glob(f"{path}/txn_year=2001/txn_month=3/*.parquet")) == untouched
    daily.merge_transactions(spark, path, _txn(spark, [(None, 8.0, 2001, 1), ("f", 6.5, 2001, 1)]))
    undated = spark.read.schema(schema).parquet(path).where("txn_year is null")
    assert undated.count() == 0
    assert spark.read.schema(schema).parquet(path).count() == 7


def _versions(spark, root, incoming):
    dim = scd2.store_read(spark, root, scd2.scd2_initial(incoming, RunConfig()).schema)
    return {(r.customer_id, r.segment, r.scd_version, r.scd_is_current) for r in dim.collect()}


def test_store_keeps_null_keys_and_takes_corrections(spark, tmp_path):
    root = str(tmp_path / "s")

    def apply(day, rows):
        incoming = spark.createDataFrame(rows, "customer_id string, segment string")
        cfg = RunConfig(as_of=date(2001, 1, day), batch_id=f"2001010{day}_000000")
        scd2.store_apply(spark, root, cfg.batch_id, incoming, cfg, tracked=("segment",))
        return incoming

    apply(1, [("c1", "Retail"), (None, "SMB")])
    incoming = apply(3, [("c1", "Premier")])
    assert _versions(spark, root, incoming) == {
        ("c1", "Retail", 1, False), ("c1", "Premier", 2, True), (None, "SMB", 1, True)}
    apply(3, [("c1", "Private"), (None, "Retail")])      # corrected rerun of the newest batch
    assert _versions(spark, root, incoming) == {
        ("c1", "Retail", 1, False), ("c1", "Private", 2, True),
        (None, "SMB", 1, False), (None, "Retail", 2, True)}
    with pytest.raises(ValueError):
        apply(2, [("c1", "SMB")])


def test_csat_matrix_shows_every_category(spark):
    class FakeLake:
        support_kpis = spark.createDataFrame(
            [("High", "fraud", 4.0), ("High", "view", 3.0)], "priority string, category string, avg_csat double")

    assert dashboard.csat_matrix(FakeLake()).columns == ["priority", "fraud", "view"]


def test_hot_cluster_value_is_split(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 50 as string)) as s")
    layout.clustered_rewrite(df, path, ["s"], ["id"], partitions=8)
    hot = spark.read.parquet(path).where("s = 'hot'").groupBy(F.col("_metadata.file_name")).count()
    assert hot.count() >= 3


def test_compaction_keeps_partitions(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    layout.write_partitioned(spark.range(0, 1000, 1, 6).selectExpr("id", "cast(id % 4 as int) m"), src, ["m"])
    layout.compact(spark, src, dst, ["m"])
    assert layout.file_stats(spark, src).first().file_count == 24
    assert layout.file_stats(spark, dst).first().file_count == 4
    assert spark.read.parquet(dst).where("m = 2").count() == 250


def test_pruned_count_reads_one_partition(spark, lake):
    plan = jobs.partition_pruned_count(lake)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_year" in plan


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app-without-folder"
        def getConf(self):
            return Conf()
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_root(Session())
