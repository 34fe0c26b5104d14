"""Sums and averages of doubles that do not depend on row order.

Summing doubles depends on the order rows arrive in, which changes with
partitioning, so reruns and cluster layouts would disagree in the last bits.
Values are summed as DECIMAL(28, 9): cents and averages keep nine decimals,
values up to 1e19 fit (a larger one fails the job rather than being cut), and
the DECIMAL(38, 9) result of SUM holds 1e10 such rows.  The result is converted
to double once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIXED = "decimal(28,9)"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def fixed(col) -> Column:
    return _c(col).cast(FIXED)


def exact_sum(col) -> Column:
    """SUM as fixed-point numbers, returned as double (NULL on no input)."""
    return F.sum(fixed(col)).cast("double")


def exact_avg(col) -> Column:
    """AVG = exact sum / non-null count (NULL when no non-null input)."""
    return exact_sum(col) / F.count(_c(col)).cast("double")
