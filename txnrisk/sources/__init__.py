from .tables import read_table
from .transactions import (transactions_from_events, load_transactions,
                           write_transactions, read_transactions, TRANSACTIONS_SCHEMA)

__all__ = ["read_table", "transactions_from_events", "load_transactions",
           "write_transactions", "read_transactions", "TRANSACTIONS_SCHEMA"]
