"""Typed serving load with rejects, schema evolution, layout jobs."""

from bankmart.operators import bronze, layout, serving
from bankmart.session import scratch_path

SPEC = [("customer_id", "string", 36), ("state", "string", 2), ("credit_score", "int", None)]


def test_typed_load_rejects(spark):
    staged = spark.createDataFrame(
        [("c1", "NY", "700"), ("c2", "NEW", "700"), ("c3", "CA", "abc"), ("c4", "TX", None),
         (None, "TX", "1")], "customer_id string, state string, credit_score string")
    loaded, rejects = serving.typed_load(staged, SPEC)
    assert sorted(r[0] for r in loaded.select("customer_id").collect()) == ["c1", "c4"]
    assert sorted(str(r[0]) for r in rejects.select("customer_id").collect()) == \
        ["None", "c2", "c3"]
    assert dict(loaded.dtypes)["credit_score"] == "int"
    assert {r["customer_id"]: r["_reasons"] for r in rejects.collect()} == {
        "c2": ["state:length"], "c3": ["credit_score:type"], None: ["customer_id:missing"]}
    assert "_sf_load_ts" in loaded.columns


def test_load_is_one_pass_and_adds_up(spark):
    import json
    path = scratch_path(spark, "load")
    staged = spark.createDataFrame(
        [("Retail", "5", 1.5), ("SMB", "many", 2.5), (None, "x" * 60, None), ("S" * 51, None, None)],
        "segment string, customer_count string, aum_total double")
    for name, typ, _ in serving.SEGMENT_SERVING:
        if name not in staged.columns:
            staged = staged.selectExpr("*", f"cast(null as {typ}) as {name}")
    assert serving.load(staged, "segment_metrics", path) == {"staged": 4, "loaded": 1, "rejected": 3}
    row = serving.read_loaded(spark, path, "segment_metrics").first()
    assert (row["segment"], row["customer_count"], row["aum_total"]) == ("Retail", 5, 1.5)
    bad = {tuple(r["_reasons"]): json.loads(r["_raw"]) for r in serving.read_rejects(spark, path).collect()}
    assert bad[("customer_count:type",)]["customer_count"] == "many"
    assert ("segment:missing", "customer_count:type") in bad and ("segment:length",) in bad


def test_schema_evolution_union(spark):
    b1 = spark.createDataFrame([("c1", 1)], "customer_id string, v int")
    b2 = spark.createDataFrame([("c2", 2, "Gold")], "customer_id string, v int, tier string")
    out = {r["customer_id"]: r["tier"] for r in bronze.schema_evolve(b1, b2).collect()}
    assert out == {"c1": None, "c2": "Gold"}


def test_partition_pruning_reaches_scan(spark):
    path = scratch_path(spark, "prune-test")
    df = spark.range(100).selectExpr("id", "cast(id % 4 as int) as m")
    layout.write_partitioned(df, path, ["m"])
    q = spark.read.parquet(path).where("m = 2")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and "(m#" in plan
    assert q.count() == 25


def test_compaction_merges_small_files_only(spark):
    import glob
    import os
    path = scratch_path(spark, "many-files")
    rows = spark.range(30_000).selectExpr("id", "md5(cast(id as string)) as t",
                                          "case id % 3 when 0 then 'a b%2+c' when 1 then 'x' end as p")
    rows.where("id < 24000").repartition(24).write.partitionBy("p").parquet(path)
    rows.where("id >= 24000").repartition(1).write.mode("append").partitionBy("p").parquet(path)
    before = {f: os.path.getsize(f) for f in glob.glob(f"{path}/*/*.parquet")}
    target = 2 * max(before.values()) - 2                    # the three large files are half the target
    large = {f for f, n in before.items() if n >= target // 2}
    assert len(large) == 1 or len(large) == 3
    written = layout.compact(spark, path, ["p"], target)
    after = {f: os.path.getsize(f) for f in glob.glob(f"{path}/*/*.parquet")}
    assert large <= set(after) and written == len(set(after) - set(before))
    assert max(after.values()) <= 1.1 * target
    for folder in {os.path.dirname(f) for f in after}:
        sizes = [n for f, n in after.items() if os.path.dirname(f) == folder]
        assert sum(n < 0.4 * target for n in sizes) <= 1 and len(sizes) < 8
    got = spark.read.parquet(path)
    assert got.count() == 30_000 and got.exceptAll(rows.select(got.columns)).count() == 0
    assert layout.compact(spark, path, ["p"], target) <= 3   # hardly anything is left to do
    assert not os.path.exists(f"{path}/_compaction")


def test_first_fit_decreasing():
    import random
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(0, 60))]
        bins = {}
        for size, b in zip(sizes, layout.pack(sizes, 100)):
            bins.setdefault(b, []).append(size)
        assert all(sum(x) <= 100 for x in bins.values()) and sum(sum(x) <= 50 for x in bins.values()) <= 1


def test_zorder_reads_fewer_row_groups_for_each_column(spark):
    import glob
    import pyarrow.parquet as pq
    df = spark.range(60_000).selectExpr(
        "cast(pmod(id * 7919, 1500) as string) as customer_id", "date_add(date'1995-01-01', cast(pmod(id * 104729, 2500) as int)) as d",
        "cast(id as string) as k", "if(id % 500 = 0, null, id) as v")
    paths = {n: scratch_path(spark, f"z-{n}") for n in ("plain", "z")}
    df.repartition(64).write.parquet(paths["plain"])
    layout.zorder_rewrite(df, paths["z"], ["customer_id", "d"], ["k"], partitions=64)

    def groups(path, column, value):
        """Row groups whose statistics do not rule the value out."""
        n = 0
        for f in glob.glob(f"{path}/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            i = pq.ParquetFile(f).schema_arrow.names.index(column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(i).statistics
                n += stats.min <= value <= stats.max
        return n

    from datetime import date
    for column, value in (("customer_id", "777"), ("d", date(1999, 5, 5))):
        assert groups(paths["z"], column, value) * 3 < groups(paths["plain"], column, value)
    got = spark.read.parquet(paths["z"])
    assert got.columns == df.columns and got.exceptAll(df).count() == 0 and got.count() == 60_000


def test_quantile_ranks_and_interleaving(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i if i else None, "x") for i in range(256)], "a int, b string")
    ranks = layout.quantile_ranks(df, ["a", "b"], bits=4)
    got = [r["r"] for r in df.select("a", ranks["a"].alias("r")).orderBy("a").collect()]
    assert got[0] == 0 and got == sorted(got) and len(set(got)) == 16
    z = spark.range(1).select(layout.interleaved([F.lit(0b1010).cast("long"), F.lit(0b0110).cast("long")], 4))
    assert z.first()[0] == 0b10_01_11_00
    empty = layout.quantile_ranks(df.limit(0), ["a"], bits=4)
    assert df.select(empty["a"].alias("r")).distinct().collect()[0]["r"] == 0


def test_streaming_landing_is_incremental(spark):
    from bankmart.session import scratch_path
    from bankmart.sources.csv import write_landing_csv
    from bankmart.streaming import land_available_now
    from bankmart.plans.jobs import bronze_schema
    from tests.helpers import frame
    from bankmart import schemas
    landing, bz, ck = (scratch_path(spark, n) for n in ("landing", "bronze", "ckpt"))
    rows = [dict(customer_id=f"c{i}", email=" x@y ", segment="Retail") for i in range(3)]
    write_landing_csv(frame(spark, schemas.CUSTOMERS, rows), landing + "/drop1")
    land_available_now(spark, "customers", landing + "/*", bz, ck)
    land_available_now(spark, "customers", landing + "/*", bz, ck)      # nothing new
    got = spark.read.schema(bronze_schema("customers", [])).parquet(bz)
    assert got.count() == 3
    assert got.first()["_source_file"].endswith(".csv")
    assert got.where("email = ' x@y '").count() == 3


def test_pk_check_flags_duplicates(spark):
    from bankmart.plans import marts

    class FakeLake:
        customer_360 = spark.createDataFrame([("c1",), ("c1",), (None,)], "customer_id string")
        segment_metrics = spark.createDataFrame([("Retail",), ("SMB",)], "segment string")

    rows = {r["table_name"]: r for r in marts.pk_check(FakeLake()).collect()}
    c = rows["customer_360"]
    assert (c["row_count"], c["distinct_keys"], c["null_keys"], c["is_unique"]) == (3, 1, 1, False)
    assert rows["segment_metrics"]["is_unique"] is True


def test_all_marts_have_serving_specs(lake):
    from bankmart.operators import serving
    for name in ["customer_360", "txn_monthly_summary", "segment_metrics", "support_kpis"]:
        spec, _ = serving.SERVING[name]
        assert {n for n, _, _ in spec} <= set(getattr(lake, name).columns)
        loaded, rejects = serving.load_table(getattr(lake, name), name)
        assert rejects.count() == 0


def test_tuning_scales_partitions(spark):
    from bankmart.session import input_bytes, tune_for_input
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        assert input_bytes(spark, ["/root/testdata/sf0.001"]) > 0
        small = tune_for_input(spark, 10 * 1024 ** 2)
        assert int(small["spark.sql.shuffle.partitions"]) == 2 * spark.sparkContext.defaultParallelism
        big = tune_for_input(spark, 100 * 1024 ** 4)           # 100 TB of Parquet
        assert int(big["spark.sql.shuffle.partitions"]) == 614_400   # no cap
        mid = tune_for_input(spark, 1024 ** 4)                  # 1 TB
        assert int(mid["spark.sql.shuffle.partitions"]) == 6144
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_csv_landing_keeps_malformed_rows(spark):
    import os
    from bankmart import schemas
    from bankmart.sources.csv import read_csv, CORRUPT
    path = scratch_path(spark, "bad-csv")
    os.makedirs(path, exist_ok=True)
    header = ",".join(f.name for f in schemas.CUSTOMERS.fields)
    good = ["c1", "A", "B", " a@b ", "", "1980-01-01", "", "", "", "NY", "01234", "US",
            "Retail", "700", "50000.0", "Verified", "false", "Web", "2000-01-01", "CRM",
            "2001-11-04T00:00:00"]
    bad = list(good)
    bad[0], bad[13] = "c2", "abc"                          # non-numeric credit score
    with open(f"{path}/part-0.csv", "w") as fh:
        fh.write(header + "\n" + ",".join(good) + "\n" + ",".join(bad) + "\n")
    rows = {r["customer_id"]: r for r in read_csv(spark, path, schemas.CUSTOMERS).collect()}
    assert rows["c1"]["zip_code"] == "01234" and rows["c1"]["email"] == " a@b "
    assert rows["c1"][CORRUPT] is None and rows["c1"]["credit_score"] == 700
    assert rows["c2"]["credit_score"] is None and "abc" in rows["c2"][CORRUPT]
