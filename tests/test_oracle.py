"""A sample of keys against the DuckDB oracle at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tools.oracle_check import TABLES, rows_of

KEYS = ["customer_360", "q1_segment_summary", "q2_churn_top100", "v5_monthly_trend",
        "dq_results", "scd2_history", "segment_metrics", "support_kpis", "layer_audit",
        "csat_matrix", "tickets_rolling_30d", "scd2_apply"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMALL)
    rel = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, rel.fetchall())
