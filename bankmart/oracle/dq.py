"""Oracle SQL for the data-quality suites, one SELECT per rule."""

from __future__ import annotations

from bankmart.config import DEFAULT
from bankmart.operators import quality as Q
from bankmart.oracle.base import CTES

SOURCE = {"customers": "(SELECT * FROM silver_customers WHERE scd_is_current)",
          "accounts": "silver_accounts", "transactions": "silver_transactions",
          "tickets": "silver_tickets"}
PARENT = {"silver.customers": "(SELECT * FROM silver_customers WHERE scd_is_current)",
          "silver.accounts": "silver_accounts"}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lit(v) -> str:
    return repr(v) if isinstance(v, float) else str(v)


def rule_sql(name: str, suite, r) -> str:
    src, t = SOURCE[name], _q(suite.table)
    tol = "CAST(NULL AS DOUBLE)" if r.tolerance_pct is None else f"CAST({r.tolerance_pct} AS DOUBLE)"
    if isinstance(r, Q.References):
        return f"""
SELECT {t} AS table_name, {_q(f"ri_{suite.table}_{r.column}")} AS check_name,
  {_q(f"{suite.table}.{r.column} EXISTS IN {r.parent}.{r.parent_column}")} AS rule, {tol} AS tolerance_pct,
  (SELECT COUNT(*) FROM {src} c WHERE NOT EXISTS
     (SELECT 1 FROM {PARENT[r.parent]} p WHERE p.{r.parent_column} = c.{r.column})) AS failing_count,
  (SELECT COUNT(*) FROM {src}) AS total_count"""
    c = r.column
    if isinstance(r, Q.NotNull):
        fail = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
    elif isinstance(r, Q.Unique):
        fail = f"COUNT(*) - COUNT(DISTINCT {c}) - COALESCE(MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0)"
    elif isinstance(r, Q.InSet):
        vals = ", ".join(_q(v) for v in r.values)
        fail = f"COUNT(*) FILTER (WHERE {c} NOT IN ({vals}))"
    else:
        fail = f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND ({c} < {_lit(r.low)} OR {c} > {_lit(r.high)}))"
    return f"""
SELECT {t} AS table_name, {_q(r.check_name)} AS check_name, {_q(r.rule)} AS rule,
  {tol} AS tolerance_pct, CAST({fail} AS BIGINT) AS failing_count, COUNT(*) AS total_count
FROM {src}"""


def results_sql(counts: str) -> str:
    return f"""
SELECT '{DEFAULT.batch_id}' AS batch_id, '{DEFAULT.run_ts.isoformat()}' AS run_ts,
  table_name, check_name, rule,
  CASE WHEN CASE WHEN total_count = 0 THEN TRUE
                 WHEN tolerance_pct IS NOT NULL THEN failing_count / total_count * 100 <= tolerance_pct
                 ELSE failing_count = 0 END THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(failing_count AS BIGINT) AS failing_count, CAST(total_count AS BIGINT) AS total_count,
  CASE WHEN total_count > 0 THEN round((1 - failing_count / total_count) * 100, 2)
       ELSE 100.0::DOUBLE END AS pass_pct
FROM ({counts}) c"""


def suite_sql(name: str) -> str:
    suite = Q.SUITES[name]
    return results_sql("\nUNION ALL\n".join(rule_sql(name, suite, r) for r in suite.rules))


def kind_sql(kind) -> str:
    parts = [rule_sql(n, s, r) for n, s in Q.SUITES.items() for r in s.rules
             if isinstance(r, kind)]
    return results_sql("\nUNION ALL\n".join(parts))


CTES["dq_results"] = "\nUNION ALL\n".join(suite_sql(n) for n in Q.SUITES)


def _register():
    from bankmart.oracle.queries import add
    for name in Q.SUITES:
        add(f"dq_suite_{name}", suite_sql(name))
    add("dq_not_null", kind_sql(Q.NotNull))
    add("dq_unique", kind_sql(Q.Unique))
    add("dq_value_in_set", kind_sql(Q.InSet))
    add("dq_range", kind_sql(Q.InRange))
    add("dq_referential_integrity", kind_sql(Q.References))
    add("dq_results", "SELECT * FROM dq_results")
    add("dq_summary", "SELECT status, COUNT(*) AS check_count FROM dq_results GROUP BY status")
    add("dq_failed_checks", """
SELECT table_name, check_name, failing_count, total_count FROM dq_results WHERE status = 'FAIL'""")
    add("dq_gate", f"""
SELECT COUNT(*) FILTER (WHERE status = 'PASS') AS pass_count,
  COUNT(*) FILTER (WHERE status = 'FAIL') AS fail_count,
  (COUNT(*) FILTER (WHERE status = 'FAIL') = 0 OR {str(not DEFAULT.abort_on_failure).upper()}) AS promote
FROM dq_results""")
    add("q10_dq_latest", """
SELECT table_name, check_name, status, failing_count, total_count, pass_pct, run_ts
FROM dq_results WHERE batch_id = (SELECT MAX(batch_id) FROM dq_results)
ORDER BY status DESC, table_name, check_name""")


_register()
