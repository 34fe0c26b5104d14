"""Data-quality rules: NULL handling, empty tables, tolerance, gate."""

import pytest

from bankmart.config import RunConfig
from bankmart.operators import quality as Q


def _run(spark, values, rules, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {typ}")
    out = Q.run_suite(df, Q.Suite("t", rules))
    return {r["check_name"]: r for r in out.collect()}


def test_null_semantics_per_rule(spark):
    got = _run(spark, ["a", "x", None],
               [Q.InSet("c", ("a", "b")), Q.NotNull("c"), Q.Unique("c")])
    assert got["value_set_c"]["failing_count"] == 1
    assert got["not_null_c"]["failing_count"] == 1
    assert got["unique_c"]["failing_count"] == 0


def test_unique_counts_null_as_one_value(spark):
    got = _run(spark, ["a", None, None], [Q.Unique("c")])
    assert got["unique_c"]["failing_count"] == 1


def test_empty_table_passes(spark):
    got = _run(spark, [], [Q.NotNull("c"), Q.Unique("c"), Q.InSet("c", (1,)),
                           Q.InRange("c", 0, 1)], typ="int")
    for r in got.values():
        assert (r["status"], r["pass_pct"], r["failing_count"], r["total_count"]) == \
            ("PASS", 100.0, 0, 0)


def test_range_and_tolerance(spark):
    vals = [1, 2, 3, 1000, None] + [5] * 195          # 1 of 200 out of range = 0.5 %
    got = _run(spark, vals, [Q.InRange("c", 0, 100, 0.5)], typ="int")
    r = got["range_c"]
    assert (r["failing_count"], r["total_count"], r["status"], r["pass_pct"]) == \
        (1, 200, "PASS", 99.5)
    got = _run(spark, vals, [Q.InRange("c", 0, 100, 0.4)], typ="int")
    assert got["range_c"]["status"] == "FAIL"


def test_rule_text_matches_audit_format(spark):
    assert Q.NotNull("email", 1.0).rule == "email IS NOT NULL (tolerance 1.0%)"
    assert Q.InRange("amount", 0.01, 10_000_000, 0.1).rule == "0.01 <= amount <= 10000000"
    assert Q.InSet("d", ("Debit", "Credit")).rule == "d IN ['Debit', 'Credit']"


def test_referential_integrity_null_key_fails(spark):
    child = spark.createDataFrame([("p1",), ("p2",), (None,), ("p1",)], "k string")
    parent = spark.createDataFrame([("p1",)], "id string")
    suite = Q.Suite("child", [Q.References("k", "parent", "id")])
    r = Q.run_suite(child, suite, {"parent": parent}).first()
    assert (r["failing_count"], r["total_count"], r["status"]) == (2, 4, "FAIL")
    assert r["check_name"] == "ri_child_k"


def test_suite_is_one_aggregate(spark):
    df = spark.range(10).selectExpr("cast(id as string) as c")
    out = Q.run_suite(df, Q.Suite("t", [Q.NotNull("c"), Q.InSet("c", ("1",)),
                                        Q.InRange("c", 0, 5)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one partial + one final aggregate, one scan, for all rules of the table
    assert plan.count("HashAggregate") <= 2 and plan.count("Range") == 1


def test_gate_blocks_or_promotes(spark):
    dq = spark.createDataFrame([("FAIL", "x"), ("PASS", "y")], "status string, check_name string")
    with pytest.raises(Q.DataQualityError):
        Q.enforce_gate(dq, RunConfig(abort_on_failure=True))
    assert Q.enforce_gate(dq, RunConfig(abort_on_failure=False))["promote"] is True


def test_production_suites_on_test_data(lake):
    dq = lake.dq_results
    rows = dq.collect()
    assert len(rows) == 32
    assert all(r["total_count"] - r["failing_count"] >= 0 for r in rows)
    assert {r["table_name"] for r in rows} == {"silver.customers", "silver.accounts",
                                               "silver.transactions", "silver.support_tickets"}
