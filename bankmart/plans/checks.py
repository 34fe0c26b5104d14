"""Registered data-quality queries: suites, rule kinds, results, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bankmart.operators import quality as Q
from bankmart.plans.catalogue import query
from bankmart.plans.lake import Lake



def _suite_query(name):
    return lambda lake: Q.run_named_suite(lake, name, lake.cfg)


for _name in Q.SUITES:
    query(f"dq_suite_{_name}")(_suite_query(_name))

for _key, _kind in [("dq_not_null", Q.NotNull), ("dq_unique", Q.Unique),
                    ("dq_value_in_set", Q.InSet), ("dq_range", Q.InRange),
                    ("dq_referential_integrity", Q.References)]:
    query(_key)((lambda kind: lambda lake: Q.run_kind(lake, kind, lake.cfg))(_kind))


@query("dq_results")
def dq_results(lake: Lake) -> DataFrame:
    return lake.dq_results


@query("dq_summary")
def dq_summary(lake: Lake) -> DataFrame:
    return Q.summary(lake.dq_results)


@query("dq_gate")
def dq_gate(lake: Lake) -> DataFrame:
    return Q.gate(lake.dq_results, lake.cfg)


@query("dq_failed_checks")
def dq_failed_checks(lake: Lake) -> DataFrame:
    """Failed checks of the run, as the summary lists them."""
    return Q.failed_checks(lake.dq_results)
