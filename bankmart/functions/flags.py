"""Customer flags, three-valued like the SQL they come from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankmart import domains as D


def churn_flag(days="days_since_last_txn", csat="avg_csat_score",
               escalated="escalated_tickets") -> Column:
    """Inactive > 90 d OR CSAT < 3.0 OR escalations > 1.

    NULL inputs make a comparison NULL; the OR is TRUE if any arm is TRUE,
    FALSE only if all arms are FALSE, else NULL.  Kept on purpose.
    """
    return ((F.col(days) > D.CHURN_INACTIVE_DAYS)
            | (F.col(csat) < D.CHURN_MIN_CSAT)
            | (F.col(escalated) > D.CHURN_MAX_ESCALATIONS))


def high_value_flag(balance="total_balance", segment="segment") -> Column:
    return ((F.col(balance) > D.HIGH_VALUE_BALANCE)
            | F.col(segment).isin(*D.HIGH_VALUE_SEGMENTS))
