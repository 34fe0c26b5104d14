"""bankmart — a PySpark-native customer-analytics engine for retail banking.

Layers: sources (extract adapters, typed CSV) → bronze (stamped append-only)
→ silver (typed, de-duplicated, SCD2 customers) → data quality gate → gold
marts → analytics queries, serving views and dashboard queries.  Everything
is DataFrame/SQL on Spark; the run date is an explicit argument (RunConfig).
"""

from bankmart.config import RunConfig

__all__ = ["RunConfig"]
