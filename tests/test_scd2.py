"""SCD2 apply/history on the micro-fixture and its invariants."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import Window

from bankmart.config import RunConfig
from bankmart.operators import scd2

D1, D2 = date(2001, 1, 1), date(2001, 2, 1)
TRACK = ("segment",)


def _dim(spark):
    cur = spark.createDataFrame([("c1", "Retail"), ("c2", "Retail"), ("c3", None)],
                                "customer_id string, segment string")
    return scd2.scd2_initial(cur, RunConfig(as_of=D1))


def _incoming(spark):
    return spark.createDataFrame([("c1", "Premier"), ("c2", "Retail"), ("c3", "SMB"),
                                  ("c4", "SMB")], "customer_id string, segment string")


def _key(t):
    return tuple((x is None, x) for x in t)


def _rows(df):
    return sorted(((r["customer_id"], r["segment"], r["scd_version"], r["scd_is_current"],
                    r["scd_start_date"], r["scd_end_date"]) for r in df.collect()), key=_key)


def test_apply_micro_fixture(spark):
    out = scd2.scd2_apply(_dim(spark), _incoming(spark), RunConfig(as_of=D2), tracked=TRACK)
    assert _rows(out) == sorted([
        ("c1", "Retail", 1, False, D1, D2), ("c1", "Premier", 2, True, D2, None),
        ("c2", "Retail", 1, True, D1, None),
        ("c3", None, 1, False, D1, D2), ("c3", "SMB", 2, True, D2, None),
        ("c4", "SMB", 1, True, D2, None)], key=_key)


def test_apply_is_idempotent(spark):
    cfg = RunConfig(as_of=D2)
    once = scd2.scd2_apply(_dim(spark), _incoming(spark), cfg, tracked=TRACK)
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = scd2.scd2_apply(once, _incoming(spark), cfg, tracked=TRACK)
    assert _rows(twice) == _rows(once)


def test_absent_keys_stay_current(spark):
    out = scd2.scd2_apply(_dim(spark), _incoming(spark).where("customer_id = 'c4'"),
                          RunConfig(as_of=D2), tracked=TRACK)
    assert out.where("scd_is_current").count() == 4
    assert out.count() == 4


def test_versions_are_emitted_by_cases(spark):
    """Changed, unchanged, absent, new and null keys, without an interpreted filter of both versions."""
    old = spark.createDataFrame([("c1", "Retail"), ("c2", "Retail"), ("c3", None), (None, "SMB")],
                                "customer_id string, segment string")
    new = spark.createDataFrame([("c1", None), ("c2", "Retail"), ("c4", None), (None, "Retail")], old.schema)
    out = scd2.scd2_apply(scd2.scd2_initial(old, RunConfig(as_of=D1)), new, RunConfig(as_of=D2), tracked=TRACK)
    assert _rows(out) == sorted([
        ("c1", "Retail", 1, False, D1, D2), ("c1", None, 2, True, D2, None), ("c2", "Retail", 1, True, D1, None),
        ("c3", None, 1, True, D1, None), ("c4", None, 1, True, D2, None),
        (None, "SMB", 1, False, D1, D2), (None, "Retail", 2, True, D2, None)], key=_key)
    assert "lambdafunction" not in out._jdf.queryExecution().executedPlan().toString()


def test_new_and_changed_keys(spark):
    new = scd2.scd2_new_keys(_dim(spark), _incoming(spark))
    assert [r[0] for r in new.select("customer_id").collect()] == ["c4"]
    ch = scd2.scd2_changed_keys(_dim(spark), _incoming(spark), tracked=TRACK)
    assert sorted(r[0] for r in ch.select("customer_id").collect()) == ["c1", "c3"]


def test_history_collapses_same_day_and_is_consistent(spark):
    log = spark.createDataFrame([
        ("c1", "A", D1, 1), ("c1", "B", D1, 2),          # same day: last wins (B)
        ("c1", "B", date(2001, 1, 5), 3),                # no change
        ("c1", None, date(2001, 1, 9), 4),               # value -> NULL is a change
        ("c2", "A", D1, 5)],
        "customer_id string, segment string, effective_date date, seq long")
    h = scd2.scd2_history(log, tracked=TRACK)
    assert _rows(h) == sorted([
        ("c1", "B", 1, False, D1, date(2001, 1, 9)), ("c1", None, 2, True, date(2001, 1, 9), None),
        ("c2", "A", 1, True, D1, None)], key=_key)
    got = scd2.scd2_as_of(h, date(2001, 1, 8)).select("customer_id", "segment").collect()
    assert sorted(tuple(r) for r in got) == [("c1", "B"), ("c2", "A")]


def test_history_invariants_on_test_data(lake):
    from bankmart.plans.history import history
    h = history(lake)
    w = Window.partitionBy("customer_id").orderBy("scd_version")
    checks = h.withColumn("prev_end", F.lag("scd_end_date").over(w)).agg(
        F.count_if(F.col("scd_version") == 1).alias("firsts"),
        F.countDistinct("customer_id").alias("keys"),
        F.count_if(F.col("scd_is_current")).alias("current"),
        F.count_if(F.col("prev_end").isNotNull()
                   & (F.col("prev_end") != F.col("scd_start_date"))).alias("gaps"),
        F.count_if(F.col("scd_end_date") <= F.col("scd_start_date")).alias("empty")).first()
    assert checks["firsts"] == checks["keys"] == checks["current"]
    assert checks["gaps"] == 0 and checks["empty"] == 0


# ── eight tracked columns ────────────────────────────────────────────────────

TYPES = {"credit_score": "int", "annual_income": "double"}
STATE = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in scd2.D.SCD2_TRACKED)
VALUES = ["Retail", 700, 50000.0, "Verified", "1 Main St", "Town", "NY", "01234"]


def _log(spark):
    """One customer per tracked column, which goes from a value to NULL and back."""
    rows = []
    for i, column in enumerate(scd2.D.SCD2_TRACKED):
        gone = [*VALUES[:i], None, *VALUES[i + 1:]]
        for day, state in ((1, VALUES), (2, VALUES), (3, gone), (4, gone), (5, VALUES)):
            rows.append((column, *state, date(2001, 1, day), day))
    rows.append(("all", *VALUES, D1, 1))
    rows.append(("all", *[None] * 8, D2, 2))
    return spark.createDataFrame(rows, f"customer_id string, {STATE}, effective_date date, seq long")


def test_history_of_every_column_to_and_from_null(spark):
    h = scd2.scd2_history(_log(spark), tracked=scd2.D.SCD2_TRACKED)
    found = {}
    for r in h.orderBy("customer_id", "scd_version").collect():
        found.setdefault(r["customer_id"], []).append((r["scd_start_date"], r["scd_changed"]))
    assert found.pop("all") == [(D1, 0), (D2, 255)]
    assert found == {c: [(D1, 0), (date(2001, 1, 3), 1 << i), (date(2001, 1, 5), 1 << i)]
                     for i, c in enumerate(scd2.D.SCD2_TRACKED)}


def test_changed_keys_name_the_columns(spark):
    log = _log(spark)
    old, new = (log.where(f"seq = {n} and customer_id != 'all'").drop("effective_date", "seq") for n in (2, 3))
    got = scd2.scd2_changed_keys(scd2.scd2_initial(old), new)
    assert {r["customer_id"]: r["changed_columns"] for r in got.collect()} == {
        c: 1 << i for i, c in enumerate(scd2.D.SCD2_TRACKED)}
    assert scd2.scd2_changed_keys(scd2.scd2_initial(old), old).count() == 0


def test_digest_tells_null_from_text_and_neighbours(spark):
    rows = [(None, "a"), ("", "a"), ("-", "a"), ("a", None), ("a", ""), ("1:a", "b"), ("1", ":ab"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string").select(scd2.row_digest(["x", "y"]).alias("d"))
    assert df.distinct().count() == len(rows)


# ── the bucketed store ───────────────────────────────────────────────────────

def _batches(spark, log):
    return [(day, log.where(f"seq = {day}").drop("effective_date", "seq")) for day in range(1, 6)]


def test_store_equals_history_and_retires_current_versions(spark):
    import os
    from bankmart.session import scratch_path
    root = scratch_path(spark, "scd2-test")
    log = _log(spark).where("customer_id != 'all'")
    nobody = log.where("customer_id = 'city'").withColumn("customer_id", F.lit(None).cast("string"))
    log = log.unionByName(nobody)
    for day, incoming in _batches(spark, log):
        cfg = RunConfig(as_of=date(2001, 1, day), batch_id=f"2001010{day}_000000")
        for _ in range(2):                                   # a rerun changes nothing
            scd2.store_apply(spark, root, cfg.batch_id, incoming, cfg)
    schema = scd2.scd2_initial(incoming, cfg).schema.add(scd2.CHANGED, "long")
    got = scd2.store_read(spark, root, schema)
    want = scd2.scd2_history(log, tracked=scd2.D.SCD2_TRACKED)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    kept = [b for b in scd2.store_batches(spark, root)
            if os.path.isdir(f"{root}/batch={b}/scd_is_current=true")]
    assert kept == ["20010104_000000", "20010105_000000"]    # the newest and its predecessor


def test_stored_side_is_not_shuffled(spark):
    from bankmart.session import scratch_path
    root = scratch_path(spark, "scd2-plan")
    (_, first), (_, second) = _batches(spark, _log(spark))[:2]
    scd2.store_apply(spark, root, "a", first, RunConfig(as_of=D1, batch_id="a"), buckets=5)
    rows, buckets = scd2.store_next(spark, root, "b", second, RunConfig(as_of=D2, batch_id="b"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert buckets == 5 and before
    assert "SelectedBucketsCount: 5 out of 5" in plan
    lines = plan.split("\n")
    stored = next(i for i, x in enumerate(lines) if "SelectedBucketsCount" in x)
    depth = len(lines[stored]) - len(lines[stored].lstrip(" :+-"))
    for line in reversed(lines[:stored]):                    # the way up from the scan
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            assert "Exchange" not in line, plan
            depth = d
    assert plan.count("Exchange") == 1                       # the batch, into the stored buckets


def test_buckets_grow_with_the_store(spark, monkeypatch):
    import bankmart.session as session
    root = session.scratch_path(spark, "scd2-grow")
    (_, first), (_, second) = _batches(spark, _log(spark))[:2]
    scd2.store_apply(spark, root, "a", first, RunConfig(as_of=D1, batch_id="a"), buckets=2)
    monkeypatch.setattr(session, "SHUFFLE_TARGET_BYTES", 10)
    rows, buckets = scd2.store_next(spark, root, "b", second, RunConfig(as_of=D2, batch_id="b"))
    assert buckets == 4 and rows.count() == 10              # eight as before, "all" in two versions
