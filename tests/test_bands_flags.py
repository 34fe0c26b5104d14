"""Band tables and customer flags, including boundaries and NULLs."""

import pytest
from pyspark.sql import types as T

from bankmart.functions import age_band, income_tier, credit_band, churn_flag, high_value_flag


def _apply(spark, col, typ, values, expr):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(col, typ)]))
    return [r[0] for r in df.select(expr).collect()]


def test_age_band_reference_cases(spark):
    assert _apply(spark, "age", T.IntegerType(), [25, 67], age_band()) == \
        ["Gen-Z / Millennial", "Senior"]


def test_age_band_boundaries_and_null(spark):
    got = _apply(spark, "age", T.IntegerType(), [29, 30, 44, 45, 59, 60, None], age_band())
    assert got == ["Gen-Z / Millennial", "Millennial / Gen-X", "Millennial / Gen-X",
                   "Gen-X / Boomer", "Gen-X / Boomer", "Senior", "Senior"]


def test_income_tier(spark):
    vals = [40_000.0, 75_000.0, 150_000.0, 500_000.0, 49_999.99, 50_000.0, 99_999.99,
            100_000.0, 249_999.99, 250_000.0, None]
    got = _apply(spark, "annual_income", T.DoubleType(), vals, income_tier())
    assert got == ["Low", "Mid", "Upper-Mid", "High", "Low", "Mid", "Mid", "Upper-Mid",
                   "Upper-Mid", "High", "High"]


def test_credit_band_boundaries(spark):
    vals = [619, 620, 679, 680, 739, 740, 799, 800, None]
    got = _apply(spark, "credit_score", T.IntegerType(), vals, credit_band())
    assert got == ["Poor", "Fair", "Fair", "Good", "Good", "Very Good", "Very Good",
                   "Exceptional", "Exceptional"]


CHURN_SCHEMA = T.StructType([T.StructField("days_since_last_txn", T.IntegerType()),
                             T.StructField("avg_csat_score", T.DoubleType()),
                             T.StructField("escalated_tickets", T.LongType())])


@pytest.mark.parametrize("row,expected", [
    ((120, 4.0, 0), True), ((10, 2.5, 0), True), ((10, 4.0, 2), True), ((3, 4.8, 0), False),
    ((90, None, 0), None), ((91, None, 0), True), ((90, 3.0, 1), False),
    ((None, None, 2), True), ((None, 4.0, 0), None)])
def test_churn_flag_three_valued(spark, row, expected):
    df = spark.createDataFrame([row], CHURN_SCHEMA)
    assert df.select(churn_flag()).first()[0] is expected


@pytest.mark.parametrize("balance,segment,expected", [
    (200_000.0, "Retail", True), (40_000.0, "Premier", True), (5_000.0, "Retail", False),
    (100_000.0, "SMB", False), (100_000.01, "SMB", True)])
def test_high_value_flag(spark, balance, segment, expected):
    df = spark.createDataFrame([(balance, segment)], "total_balance double, segment string")
    assert df.select(high_value_flag()).first()[0] is expected
