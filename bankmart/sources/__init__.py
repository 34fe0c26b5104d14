"""Sources: driver test tables, extract adapters and typed CSV reading."""

from bankmart.sources.tables import read_table
from bankmart.sources.adapters import (customers_extract, accounts_extract,
                                       transactions_extract, tickets_extract,
                                       branches_extract, customer_change_log,
                                       segment_change_log)

__all__ = ["read_table", "customers_extract", "accounts_extract",
           "transactions_extract", "tickets_extract", "branches_extract",
           "customer_change_log", "segment_change_log"]
