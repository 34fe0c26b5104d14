"""Run parameters.  No function in the package reads the wall clock."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one daily-batch run.

    ``as_of`` replaces ``current_date()`` and ``run_ts`` replaces
    ``current_timestamp()`` everywhere, so a rerun gives the same result.
    """

    as_of: date = date(2001, 11, 4)
    run_ts: datetime = datetime(2001, 11, 4, 0, 0, 0)
    batch_id: str = "20011104_000000"
    abort_on_failure: bool = True
    # Optional look-back for the "12m" spend/deposit KPIs; None = all history
    lookback_months: int | None = None
    # Date used by the segment-change query (Q8) as "today"
    changes_as_of: date = date(2001, 8, 1)
    extra: dict = field(default_factory=dict)

    @property
    def batch_date(self) -> str:
        return self.as_of.isoformat()

    @property
    def run_ts_text(self) -> str:
        return self.run_ts.isoformat(sep=" ")

    def run_ts_col(self):
        """The run instant as a TIMESTAMP_NTZ literal (time-zone free)."""
        from pyspark.sql import functions as F
        return F.lit(self.run_ts_text).cast("timestamp_ntz")


DEFAULT = RunConfig()
