"""Sources and sinks: transaction scans, fixture edge derivation, weekly sinks."""

from txgraph.sources.fixtures import transactions_f1, transactions_f2, load_table
from txgraph.sources.transactions import (TX_SCHEMA, read_transactions, select_weeks,
                                          pending_weeks, write_weekly, read_weekly, read_week)

__all__ = ["transactions_f1", "transactions_f2", "load_table", "TX_SCHEMA",
           "read_transactions", "select_weeks", "pending_weeks", "write_weekly", "read_weekly",
           "read_week"]
