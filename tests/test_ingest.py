"""CSV drops, quarantine and schema changes, from landing to Silver."""

import dataclasses
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart import schemas
from bankmart.config import RunConfig
from bankmart.operators import bronze, evolve
from bankmart.plans import daily, jobs
from bankmart.plans.lake import Lake
from bankmart.session import scratch_path
from bankmart.sources import csv
from tests.conftest import SMALL

CFG = RunConfig(abort_on_failure=False)
NEXT = dataclasses.replace(CFG, as_of=date(2001, 11, 5), run_ts=datetime(2001, 11, 5), batch_id="20011105_000000")


def rows(df):
    df = df.select(sorted(df.columns))
    return sorted(map(str, df.collect()))


def test_daily_from_csv_equals_daily_from_the_tables(spark):
    landing = jobs.land_csv(Lake(spark, SMALL, CFG))
    a, b = scratch_path(spark, "from-tables"), scratch_path(spark, "from-csv")
    ra = daily.run(spark, SMALL, a, CFG)
    rb = daily.run(spark, None, b, CFG, landing=landing)
    assert ra.dq == rb.dq and ra.ingest == rb.ingest
    assert all(c["quarantined"] == 0 and c["loaded"] == c["file_rows"] > 0 for c in rb.ingest.values())
    for name in ra.paths:
        assert rows(spark.read.parquet(ra.paths[name])) == rows(spark.read.parquet(rb.paths[name])), name


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


HEADER = [f.name for f in schemas.BRANCHES.fields]
GOOD = ["b1", "Main", "Express", "1 St", "Town", "NY", "01234", "555", "Ann", "1999-01-01", "true", "2", "900",
        "2001-11-04T00:00:00"]


def _branch(i, **changed):
    line = {**dict(zip(HEADER, GOOD)), "branch_id": f"b{i}", **changed}
    return ",".join(line[c] for c in (*HEADER, *[c for c in line if c not in HEADER]))


def test_malformed_rows_are_quarantined_and_counts_add_up(spark):
    folder = scratch_path(spark, "bad-drop")
    lines = [",".join(HEADER), _branch(1), _branch(2, atm_count="many"), _branch(3) + ",one,more", "b4,short", _branch(5)]
    _write(folder, "a.csv", lines)
    _write(folder, "b.csv", [lines[0], _branch(6), _branch(7, is_active="perhaps")])
    df = bronze.stamp(csv.read_drop(spark, folder, schemas.BRANCHES), "S", "branches.csv", CFG)
    for landed in ("append", "refresh"):
        path = scratch_path(spark, f"bronze-{landed}")
        counts = bronze.append(df, path, CFG.batch_id, "open_date") if landed == "append" else bronze.full_refresh(df, path)
        assert counts == {"file_rows": 7, "loaded": 3, "quarantined": 4}
        assert sorted(r["branch_id"] for r in bronze.read_bronze(spark, path).collect()) == ["b1", "b5", "b6"]
        bad = {r["_corrupt_record"]: r for r in bronze.read_quarantine(spark, path).collect()}
        assert set(bad) == {lines[2], lines[3], lines[4], _branch(7, is_active="perhaps")}
        assert bad[lines[2]]["_input"].endswith("a.csv:0") and bad[lines[2]]["_batch_id"] == CFG.batch_id
        # the status prunes folders, so readers of good rows never open quarantined ones
        plan = bronze.read_bronze(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_row_status" in plan


def test_header_decides_columns(spark):
    folder = scratch_path(spark, "reordered")
    names = [*reversed(HEADER[:-1]), "region"]                         # reordered, one dropped, one new
    line = dict(zip(HEADER, GOOD), region="North")
    _write(folder, "a.csv", [",".join(names), ",".join(line[c] for c in names)])
    row = csv.read_drop(spark, folder, schemas.BRANCHES, {"region": "string"}).first()
    assert (row["branch_id"], row["atm_count"], row["zip_code"], row["region"]) == ("b1", 2, "01234", "North")
    assert row["record_created_at"] is None and row["_corrupt_record"] is None
    _write(folder, "b.csv", [",".join(HEADER), _branch(2)])            # another header in one drop
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_drop(spark, folder, schemas.BRANCHES).collect()


def _land(spark, wh, cfg, change=None, declared=None):
    lake = Lake(spark, SMALL, cfg)
    if change:
        lake._tables["extract:accounts"] = change(lake.extract("accounts"))
        lake._tables["extract:transactions"] = change(lake.extract("transactions"))
        lake._tables["extract:customers"] = change(lake.extract("customers"))
    return daily.run(spark, None, wh, cfg, landing=jobs.land_csv(lake), declared=declared)


def test_new_column_reaches_bronze_and_silver_and_widens(spark):
    wh = scratch_path(spark, "drift")
    day3 = dataclasses.replace(CFG, as_of=date(2001, 11, 6), run_ts=datetime(2001, 11, 6), batch_id="20011106_000000")

    def with_points(value):
        return lambda df: df.withColumn("points", F.lit(value))

    def types(kind):
        return {n: {"points": kind} for n in ("customers", "accounts", "transactions")}

    _land(spark, wh, CFG)
    r2 = _land(spark, wh, NEXT, with_points(7), types("int"))
    for name, keys in (("accounts", "account_id"), ("transactions", "transaction_id"), ("customers", "customer_id")):
        landed = bronze.read_bronze(spark, f"{wh}/bronze/{name}")
        assert dict(landed.dtypes)["points"] == "int"
        per_batch = {r["_batch_id"]: (r["n"], r["p"]) for r in
                     landed.groupBy("_batch_id").agg(F.count("*").alias("n"), F.count("points").alias("p")).collect()}
        assert per_batch[CFG.batch_id][1] == 0 and len(set(per_batch[NEXT.batch_id])) == 1
    for name in ("silver_accounts", "silver_transactions"):
        assert spark.read.parquet(r2.paths[name]).where("points is null").count() == 0
    r3 = _land(spark, wh, day3, with_points(2**40), types("long"))
    assert dict(bronze.read_bronze(spark, f"{wh}/bronze/accounts").dtypes)["points"] == "bigint"
    for name in ("silver_accounts", "silver_transactions"):
        assert spark.read.parquet(r3.paths[name]).select("points").distinct().first()[0] == 2**40
    # a column that goes again stays, with NULL in new rows; a conflict is refused before any write
    day4 = dataclasses.replace(CFG, as_of=date(2001, 11, 7), run_ts=datetime(2001, 11, 7), batch_id="20011107_000000")
    with pytest.raises(evolve.SchemaConflict, match="points: bigint up to batch 20011107_000000, which has string"):
        _land(spark, wh, day4, with_points("many"))
    assert "20011107_000000" not in os.listdir(f"{wh}/bronze/accounts")


def test_lattice():
    i, l, d, f, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.StringType()
    assert evolve.widen(i, l) == l and evolve.widen(l, i) == l and evolve.widen(l, d) == d
    assert evolve.widen(T.ByteType(), T.ShortType()) == T.ShortType() and evolve.widen(f, l) == d
    assert evolve.widen(T.NullType(), s) == s and evolve.widen(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert evolve.widen(i, s) is None and evolve.widen(T.BooleanType(), i) is None
    assert evolve.widen(T.ArrayType(i), T.ArrayType(l)) == T.ArrayType(l)
    a, b = (T.StructType([T.StructField("x", t)]) for t in (i, s))
    assert evolve.widen(a, b) is None and evolve.widen(a, T.StructType([T.StructField("x", d)])).fields[0].dataType == d
    schema, conflicts = evolve.merged([("1", T.StructType([T.StructField("x", i), T.StructField("y", s)])),
                                       ("2", T.StructType([T.StructField("z", d), T.StructField("x", l)])),
                                       ("3", T.StructType([T.StructField("y", i)]))])
    assert [(f.name, f.dataType) for f in schema] == [("x", l), ("y", s), ("z", d)]
    assert [str(c) for c in conflicts] == ["y: string up to batch 3, which has int"]


def test_read_without_a_ledger_uses_footers(spark):
    path = scratch_path(spark, "no-ledger")
    spark.range(3).selectExpr("cast(id as int) as v", "'m' as p").write.partitionBy("p").parquet(f"{path}/_batch_id=1")
    spark.range(2).selectExpr("id + 5000000000 as v", "id as w", "'n' as p").write.partitionBy("p").parquet(f"{path}/_batch_id=2")
    spark.range(2).selectExpr("id / 2 as v", "'o' as p").write.partitionBy("p").parquet(f"{path}/_batch_id=3")
    df = evolve.read(spark, path)
    assert dict(df.dtypes) == {"v": "double", "w": "bigint", "p": "string", "_batch_id": "string"}
    assert df.where("_batch_id = '2'").agg(F.sum("v")).first()[0] == 10000000001.0
    assert df.count() == 7 and evolve.read(spark, path, batches=["3"]).count() == 2


# ── point-in-time reads and counts ───────────────────────────────────────────

def _history(spark):
    path = scratch_path(spark, "pit")
    for day, rows in ((1, [("a", 1), ("b", 1)]), (3, [("a", 3), ("c", 3), (None, 3)]), (7, [("b", 7)])):
        cfg = dataclasses.replace(CFG, as_of=date(2001, 1, day), run_ts=datetime(2001, 1, day),
                                  batch_id=f"2001010{day}_000000")
        df = spark.createDataFrame(rows, "customer_id string, v int")
        bronze.append(bronze.stamp(df, "S", "f", cfg), path, cfg.batch_id)
    return path


def test_point_in_time_by_batch_and_instant(spark):
    path = _history(spark)
    got = {}
    instants = ("2000-12-31 00:00:00", "2001-01-03 00:00:00", "2001-01-02 23:59:59", "2001-02-01 00:00:00")
    for r in bronze.snapshot_as_of(spark, path, "customer_id", ["20010105_000000"], instants).collect():
        got.setdefault(r["asked"], set()).add((r["customer_id"], r["v"]))
    third = {("a", 3), ("b", 1), ("c", 3), (None, 3)}
    assert got == {"20010105_000000": third, instants[1]: third, instants[2]: {("a", 1), ("b", 1)},
                   instants[3]: {("a", 3), ("b", 7), ("c", 3), (None, 3)}}
    assert bronze.snapshot_as_of(spark, path, "customer_id", instants=instants[:1]).count() == 0
    # folders of later batches are not in the plan
    files = bronze.snapshot_as_of(spark, path, "customer_id", instants=instants[2:3]).inputFiles()
    assert files and all("_batch_id=20010101_000000" in f for f in files)


def test_counts_come_from_footers(spark):
    from bankmart.plans import marts
    paths = {}
    for name, n in (("t", 70), ("u", 0)):
        paths[name] = scratch_path(spark, f"count-{name}")
        spark.range(n).selectExpr("id", "id % 3 as p").write.parquet(paths[name])
    assert marts.row_counts(spark, paths) == {"t": 70, "u": 0}
    counts = marts.footer_counts(spark, paths)
    assert counts._jdf.queryExecution().toString().count("PushedAggregation: [COUNT(*)]") >= 2
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
