"""Silver transforms on micro-fixtures: dedup order, signed amount,
ratio guards, date parsing."""

from bankmart.config import RunConfig
from bankmart.operators import silver
from bankmart.operators.dedup import dedup_latest, INGEST_ORDER
from tests.helpers import bronze_frame


def test_dedup_keeps_latest_ingest(spark):
    df = spark.createDataFrame(
        [("cust-1", "Retail", "2024-01-01 10:00:00"), ("cust-1", "Premier", "2024-01-01 12:00:00")],
        "customer_id string, segment string, _ingest_ts string")
    out = dedup_latest(df, ["customer_id"], [("_ingest_ts", "desc")]).collect()
    assert len(out) == 1 and out[0]["segment"] == "Premier"


def test_dedup_tie_is_broken_by_batch(spark):
    rows = [("c1", "A", "2024-01-01 10:00:00", "b1"), ("c1", "B", "2024-01-01 10:00:00", "b2")]
    df = spark.createDataFrame(rows, "customer_id string, segment string, _ingest_ts string, "
                                     "_batch_id string")
    for _ in range(3):
        out = dedup_latest(df.repartition(3), ["customer_id"], INGEST_ORDER).collect()
        assert [r["segment"] for r in out] == ["B"]


def _txn(**kw):
    base = dict(transaction_id="t1", account_id="a1", customer_id="c1", amount=100.0,
                direction="Debit", channel="Web", transaction_date="2001-01-02",
                posting_date="2001-01-04", is_flagged=False, fraud_score=0.1)
    base.update(kw)
    return base


def test_signed_amount_and_calendar(spark):
    b = bronze_frame(spark, "transactions",
                     [_txn(), _txn(transaction_id="t2", amount=500.0, direction="Credit")])
    rows = {r["transaction_id"]: r for r in silver.silver_transactions(b).collect()}
    assert rows["t1"]["signed_amount"] == -100.0
    assert rows["t2"]["signed_amount"] == 500.0
    # 2001-01-02 was a Tuesday: 1 = Sunday … 3 = Tuesday
    assert rows["t1"]["txn_day_of_week"] == 3
    assert rows["t1"]["settlement_lag_days"] == 2
    assert (rows["t1"]["txn_year"], rows["t1"]["txn_quarter"]) == (2001, 1)


def test_bad_date_text_becomes_null_not_error(spark):
    b = bronze_frame(spark, "transactions", [_txn(transaction_date="2001-13-45")])
    r = silver.silver_transactions(b).first()
    assert r["transaction_date"] is None and r["txn_year"] is None


def test_utilization_ratio_guards(spark):
    acc = lambda i, lim: dict(account_id=f"a{i}", customer_id="c1", account_status="Active",
                              balance=500.0, credit_limit=lim, open_date="2000-01-01",
                              last_activity_date="2001-10-01")
    b = bronze_frame(spark, "accounts", [acc(1, 0.0), acc(2, None), acc(3, 2000.0)])
    rows = {r["account_id"]: r for r in silver.silver_accounts(b).collect()}
    assert rows["a1"]["utilization_rate"] is None
    assert rows["a2"]["utilization_rate"] is None and rows["a2"]["credit_limit"] == 0.0
    assert rows["a3"]["utilization_rate"] == 0.25
    assert rows["a3"]["days_since_activity"] == 34   # as of 2001-11-04


def test_customer_standardisation_and_age(spark):
    cfg = RunConfig()
    b = bronze_frame(spark, "customers", [dict(
        customer_id="c1", email="  Some.One@Example.COM ", state=" ny ", kyc_status=" Verified ",
        date_of_birth="1971-11-05", customer_since="1991-11-04", credit_score=700,
        annual_income=60000.0, segment="Retail")])
    r = silver.silver_customers(b, cfg).first()
    assert (r["email"], r["state"], r["kyc_status"]) == ("some.one@example.com", "NY", "Verified")
    assert r["age"] == 29 and r["age_band"] == "Gen-Z / Millennial"
    assert r["tenure_years"] == 10.0
    assert (r["scd_version"], r["scd_is_current"], r["scd_end_date"]) == (1, True, None)


def test_ticket_resolution(spark):
    t = dict(ticket_id="k1", customer_id="c1", category="x", priority="Low", status="Closed",
             created_date="2001-01-01", resolved_date="2001-01-08", csat_score=4, is_escalated=False)
    b = bronze_frame(spark, "support_tickets", [t, {**t, "ticket_id": "k2", "status": "Open",
                                                   "resolved_date": None}])
    rows = {r["ticket_id"]: r for r in silver.silver_tickets(b).collect()}
    assert rows["k1"]["resolution_days"] == 7 and rows["k1"]["is_resolved"] is True
    assert rows["k2"]["resolution_days"] is None and rows["k2"]["is_resolved"] is False
