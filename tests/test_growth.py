"""Jobs on large inputs: no lineage runs twice, nothing is written or shuffled in vain."""

import glob
import os
import time

import pytest
from pyspark.sql import DataFrame

from bankmart import schemas, session
from bankmart.operators import bronze, layout
from bankmart.plans import jobs, marts
from bankmart.plans.lake import Lake
from bankmart.session import scratch_path
from bankmart.sources import csv as csv_src
from tests.helpers import frame


@pytest.fixture(scope="module")
def own_lake(spark):
    """A lake over rows of its own: repeated and null keys among them."""
    lake = Lake(spark, None)
    rows = {
        "customers": [{"customer_id": str(i), "segment": "Retail", "state": "AA", "credit_score": 700,
                       "kyc_status": "Verified", "email": "a@b"} for i in range(4)],
        "accounts": [{"account_id": str(i % 5), "customer_id": str(i % 4), "product_type": "CD", "balance": 10.5 * i,
                      "account_status": "Active"} for i in range(6)],
        "transactions": [{"transaction_id": str(i % 18), "account_id": str(i % 5), "customer_id": str(i % 4) if i else None,
                          "amount": 1.25 * i, "direction": "Debit" if i % 2 else "Credit", "fraud_score": 0.5,
                          "channel": "Web", "is_flagged": False, "reference_number": f"R{i}",
                          "transaction_date": f"1998-0{i % 3 + 2}-03" if i != 7 else None} for i in range(20)],
        "branches": [{"branch_id": "1", "atm_count": 2}],
        "support_tickets": [{"ticket_id": str(i), "customer_id": str(i), "category": "x", "priority": "Low",
                             "created_date": "1998-03-03", "status": "Open"} for i in range(3)]}
    for name, schema in schemas.SOURCES.items():
        lake._tables[f"extract:{name}"] = frame(spark, schema, rows[name])
    return lake


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _same_rows(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_served_tables_are_computed_once(own_lake):
    staged = jobs._serving_staged(own_lake)
    for name, df in staged.items():
        assert "Window" not in _plan(df) and "Aggregate" not in _plan(df)
        assert _same_rows(getattr(own_lake, name), df)
    for df in jobs._damaged_marts(own_lake).values():
        assert "Window" not in _plan(df) and "Aggregate" not in _plan(df)


def test_clustered_tables_are_computed_once(own_lake, monkeypatch):
    seen = []
    for name in ("clustered_rewrite", "zorder_rewrite"):
        plain = getattr(layout, name)
        monkeypatch.setattr(layout, name, lambda df, *a, plain=plain, **k: (seen.append(_plan(df)), plain(df, *a, **k)))
    got = jobs.clustered_rewrite(own_lake)
    assert len(seen) == 3 and not any("Window" in p or "Aggregate" in p for p in seen)
    assert got.where("table_name = 'silver_transactions'").count() == 18


def test_audited_tables_need_no_layout(own_lake, spark):
    paths = marts.written_tables(own_lake)
    assert not glob.glob(f"{paths['silver_transactions']}/txn_year=*")
    assert marts.row_counts(spark, paths)["silver_transactions"] == 18


def test_written_tables_are_kept(own_lake):
    once = own_lake.written_once(["silver_transactions"])
    more = once.written_once(["silver_transactions", "txn_monthly_summary"])
    assert more.paths["silver_transactions"] == once.paths["silver_transactions"]
    assert once.written_once(["silver_transactions"]) is once
    assert _same_rows(own_lake.txn_monthly_summary, more.txn_monthly_summary)


def test_overwritten_partitions_read_a_written_table(own_lake, monkeypatch):
    seen, plain = [], layout.write_partitioned_balanced
    monkeypatch.setattr(layout, "write_partitioned_balanced",
                        lambda df, *a, **k: (seen.append(_plan(df)), plain(df, *a, **k)))
    got = jobs.partitioned_overwrite(own_lake)
    assert len(seen) == 2 and not any("Window" in p for p in seen)
    assert _same_rows(own_lake.silver_transactions, got)


def test_drops_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(csv_src, "ROWS_PER_FILE", 100)
    path, df = scratch_path(spark, "drop"), spark.range(250).selectExpr("cast(id as string) as branch_id").coalesce(1)
    csv_src.write_landing_csv(df, path, compressed=True)
    assert len(glob.glob(f"{path}/*.csv.gz")) == 3 and not glob.glob(f"{path}/*.csv")
    got = csv_src.read_drop(spark, path, schemas.BRANCHES)
    assert sorted(int(r.branch_id) for r in got.collect()) == list(range(250))


def test_stamps_are_set_after_the_shuffle(spark):
    df = spark.createDataFrame([("1", "2001-01-01"), (None, "bad"), ("2", None)], "k string, d string")
    stamps = bronze.stamps("S", "f.csv")
    for date_col in ("d", None):
        before, after = scratch_path(spark, "stamped"), scratch_path(spark, "stamped")
        counts = bronze.append(bronze.stamp(df, "S", "f.csv"), before, "1", date_col)
        assert bronze.append(df, after, "1", date_col, stamps) == counts == {
            "file_rows": 3, "loaded": 3, "quarantined": 0}
        a, b = bronze.read_bronze(spark, before), bronze.read_bronze(spark, after)
        assert a.columns == b.columns and _same_rows(a, b)


def test_bins_are_merged_without_a_shuffle(spark, monkeypatch):
    path = scratch_path(spark, "bins")
    layout.write_partitioned(spark.range(0, 1000, 1, 6).selectExpr("id", "nullif(id % 4, 3) as m"), path, ["m"])
    monkeypatch.setattr(DataFrame, "repartition", None)
    assert layout.compact(spark, path, ["m"]) == 4
    got = spark.read.parquet(path)
    assert layout.file_stats(spark, path).first().file_count == 4
    assert got.count() == 1000 and got.select("id").distinct().count() == 1000
    assert got.where("m = 2").count() == 250 and got.where("m is null").count() == 250


def _shuffle_blocks(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle")}


def test_large_tables_are_written_in_slices_of_whole_keys(own_lake, spark, monkeypatch):
    whole = own_lake.written_once(Lake.SILVER + Lake.GOLD)
    monkeypatch.setattr(session, "SLICED_BYTES", 0)
    lake = Lake(spark, None)
    lake._tables = dict(own_lake._tables)
    more = frame(spark, schemas.TRANSACTIONS, [{"transaction_id": None, "amount": a, "reference_number": r}
                                               for a, r in ((1.0, "S"), (2.0, "T"))])
    lake._tables["extract:transactions"] = own_lake.extract("transactions").unionByName(more)
    lake._tables.pop("silver_transactions", None)
    parts = lake._slices(lake.silver_transactions, "silver_transactions")
    assert len(parts) == Lake.SLICES
    for p in map(_plan, parts):                     # the other rows do not reach the shuffle
        assert p.index("Window") < p.index("xxhash64")
    assert len(lake._slices(lake.silver_branches, "silver_branches")) == 1
    assert _same_rows(lake.silver_transactions, lake.written_once(["silver_transactions"]).silver_transactions)
    assert lake.silver_transactions.count() == 19
    once = own_lake.written_once(Lake.SILVER + Lake.GOLD)
    for name in Lake.SILVER + Lake.GOLD:
        assert _same_rows(getattr(whole, name), getattr(once, name))


def test_shuffle_files_end_with_their_write(own_lake, spark):
    before = _shuffle_blocks(spark)
    own_lake.written_once(["silver_transactions", "txn_monthly_summary"])
    for _ in range(50):                             # they are deleted in the background
        if not _shuffle_blocks(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_blocks(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_audit_drops_only_what_it_wrote(own_lake, spark, monkeypatch):
    kept, seen, plain = own_lake.written_once(["silver_transactions"]), {}, marts.written_tables
    monkeypatch.setattr(marts, "written_tables", lambda lake: seen.update(plain(lake)) or seen)
    got = {(r.layer, r.table_name): r.row_count for r in marts.layer_audit(kept).collect()}
    assert got["silver", "silver_transactions"] == 18 and got["bronze", "transactions"] == 20
    assert [n for n, p in seen.items() if os.path.exists(p)] == ["silver_transactions"]
    assert kept.silver_transactions.count() == 18


def test_large_tables_are_zordered_in_parts(spark, monkeypatch):
    df = spark.range(6000).selectExpr(
        "if(id % 50 = 0, null, cast(pmod(id * 7919, 1500) as string)) as c",
        "if(id % 70 = 0, null, date_add(date'1995-01-01', cast(pmod(id * 104729, 2500) as int))) as d",
        "if(id % 9 = 0, null, id) as k", "cast(id % 2 as string) as few")
    df = df.unionByName(df.where("k % 10 = 3"))                     # rows that come twice
    for by, number in ((["c", "d"], 2), (["few", "d"], 1)):
        monkeypatch.setattr(session, "SLICED_BYTES", 0)
        path, bounds = scratch_path(spark, "zorder-parts"), layout.quantile_bounds(df, by)
        parts = layout._halves(df, by[0], bounds[by[0]], 16)
        assert len(parts) == number and sum(p.count() for p, _ in parts) == df.count()
        assert all(abs(n * number - 16) <= 1 for _, n in parts)
        layout.zorder_rewrite(df, path, by, ["k"], partitions=16)
        got = spark.read.parquet(path)
        assert got.columns == df.columns and _same_rows(df, got)
        halves = got.select("_metadata.file_name", layout.upper_half(by[0], bounds[by[0]]).alias("half")).distinct()
        assert halves.count() == halves.select("file_name").distinct().count()     # no file spans two parts
        monkeypatch.setattr(session, "SLICED_BYTES", 1 << 40)
        assert len(layout._halves(df, by[0], bounds[by[0]], 16)) == 1


def test_empty_tables_are_zordered(spark, monkeypatch):
    monkeypatch.setattr(session, "SLICED_BYTES", 0)
    path = scratch_path(spark, "zorder-empty")
    layout.zorder_rewrite(spark.range(0).selectExpr("id", "id as d"), path, ["id", "d"], ["id"], partitions=4)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id", "d"]


def test_jobs_drop_the_tables_they_wrote(own_lake, spark, monkeypatch):
    seen, plain = {}, Lake.written_once

    def written_once(self, *args):
        lake = plain(self, *args)
        seen.update(lake.paths)
        return lake

    kept = own_lake.written_once(["silver_transactions"])
    monkeypatch.setattr(Lake, "written_once", written_once)
    for job, whole in ((jobs.clustered_rewrite, {"silver_transactions"}), (jobs.serving_ledger, {"silver_transactions", "segment_metrics", "dq_results"}),
                       (jobs.serving_load, {"silver_transactions", *Lake.GOLD, "dq_results"})):
        seen.clear()
        job(kept).count()
        assert len(seen) > 3 and {n for n, p in seen.items() if os.path.exists(p)} == whole
    seen.clear()
    jobs.partitioned_overwrite(own_lake).count()
    assert not os.path.exists(seen["silver_transactions"])
