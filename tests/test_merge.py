"""Keyed tables: merging batches equals a rebuild and touches only what it must."""

import dataclasses
import glob
import os
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from bankmart.config import RunConfig
from bankmart.operators import merge
from bankmart.operators.merge import KeyedTable
from bankmart.session import scratch_path

SCHEMA = "id string, v int, place string"


def _files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_batches_equal_a_rebuild(spark, monkeypatch):
    monkeypatch.setattr(merge, "FOLD", 2)
    rng = random.Random(2)
    places = ["a", "b/c", "x=1 %2", "d", None, "Auto Loan"]
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "id", ["place"])
    state = {i: (f"k{i}", 0, rng.choice(places)) for i in range(40)}
    state[99] = (None, 0, "a")
    first = spark.createDataFrame(list(state.values()), SCHEMA)
    table.rebuild(first, "d0")
    for day in range(1, 7):
        batch = {i: (f"k{i}", day, rng.choice(places)) for i in rng.sample(range(60), 5)}
        if day == 2:                                  # a partition loses its last row
            batch = {i: (f"k{i}", day, "d") for i, row in state.items() if row[2] == "x=1 %2"}
        if day == 3:
            batch = {99: (None, 3, "b/c")}
        new = spark.createDataFrame(list(batch.values()), SCHEMA)
        before, index = _files(table.path), len(os.listdir(table.index_path))
        touched = table.merge(new, f"d{day}")
        after = _files(table.path)
        old = {state[i][2] for i in batch if i in state}
        own = {r[2] for r in batch.values()}
        assert {p or merge.UNKNOWN for p in old | own} <= set(touched)
        state.update(batch)
        got = table.read(new.schema).collect()
        assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(list(state.values()), SCHEMA).collect()))
        kept = {f for f in before if not any(table._folder(t) and f.startswith(table._folder(t)) for t in touched)}
        assert {f: before[f] for f in kept if f in after} == {f: after[f] for f in kept if f in after}
        homes = table._folders()
        assert f"d{day}" in homes and len(homes) <= 3 and index
    assert table._folder("x=1 %2") is None or any(r[2] == "x=1 %2" for r in state.values())


def test_an_empty_batch_changes_nothing(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed-empty"), "id", ["place"])
    first = spark.createDataFrame([("a", 1, "p")], SCHEMA)
    table.rebuild(first, "d0")
    before = _files(table.path)
    assert table.merge(first.limit(0), "d1") == [] and _files(table.path) == before


def test_index_lookup_moves_only_the_batch(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed-plan"), "id", ["place"])
    table.rebuild(spark.range(500).selectExpr("cast(id as string) id", "1 v", "cast(id % 7 as string) place"), "d0")
    n = merge.noted_buckets(spark, f"{table.index_path}/_buckets")
    ids = spark.createDataFrame([("3", 2, "p")], SCHEMA).select(merge._key("id").alias("id")).distinct().repartition(n, "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = table._indexed().join(ids.hint("merge"), "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.split("\n")
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "bucketed" in x)
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    assert not any("Exchange" in x for x in lines[join:scan]), plan
    assert table.homes(spark.createDataFrame([("3", 2, "p"), ("5", 2, "q"), ("nope", 1, "p")], SCHEMA)) == ["3", "5"]


def test_daily_cost_does_not_grow_with_days(spark):
    """Three small days after a first load: each rewrites only the months of its own rows,
    and Silver equals a rebuild from all of Bronze."""
    from bankmart.operators import bronze
    from bankmart.plans import daily
    from bankmart.plans.lake import Lake
    from tests.conftest import SMALL
    wh = scratch_path(spark, "daily-days")
    cfg = RunConfig(abort_on_failure=False)
    original = Lake.extract
    source = {n: Lake(spark, SMALL, cfg).extract(n) for n in ("accounts", "support_tickets", "transactions")}
    source["support_tickets"] = source["support_tickets"].withColumn(      # over many months
        "created_date", F.expr("cast(date_add(date'2000-01-01', cast(ticket_id as int) % 300) as string)"))

    def run(c, tables):
        Lake.extract = lambda self, name: tables[name] if name in tables else original(self, name)
        try:
            daily.run(spark, SMALL, wh, c)
        finally:
            Lake.extract = original

    run(cfg, source)
    for n in range(1, 3):
        day = cfg.as_of + timedelta(days=n)
        c = dataclasses.replace(cfg, as_of=day, run_ts=datetime(day.year, day.month, day.day),
                                batch_id=day.strftime("%Y%m%d_000000"))
        # a few rows that change, one of which moves to another partition
        some = {"accounts": source["accounts"].where("product_type = 'CD'").limit(5)
                .withColumn("balance", F.lit(1.0 * n)),
                "support_tickets": source["support_tickets"].orderBy("ticket_id").limit(4)
                .withColumn("csat_score", F.lit(n)),
                "transactions": source["transactions"].orderBy("transaction_id").limit(4)
                .withColumn("transaction_date", F.lit(date(1997, 1, n).isoformat()))}
        before = {t: _files(f"{wh}/silver/{t}") for t in Lake.MERGED}
        run(c, some)
        after = {t: _files(f"{wh}/silver/{t}") for t in Lake.MERGED}
        for t in Lake.MERGED:
            same = [f for f in before[t] if before[t][f] == after[t].get(f)]
            assert len(same) > 0.5 * len(before[t]), (t, len(same), len(before[t]))
        for t, (name, key, by) in Lake.MERGED.items():
            rebuilt = Lake.clean(t, bronze.read_bronze(spark, f"{wh}/bronze/{name}").drop("_month"), c)
            stored = spark.read.schema(rebuilt.schema).parquet(f"{wh}/silver/{t}").select(rebuilt.columns)
            assert sorted(map(str, stored.collect())) == sorted(map(str, rebuilt.collect())), t
