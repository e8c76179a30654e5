"""Readers, writers and the views the test tables are seen through."""

from txrisk.sources.tables import read_raw_csv, read_table, write_csv, write_table
from txrisk.sources.views import faulty_messages, keyed_features, messages, raw_transactions, scored, transactions

__all__ = [
    "faulty_messages",
    "keyed_features",
    "messages",
    "raw_transactions",
    "read_raw_csv",
    "read_table",
    "scored",
    "transactions",
    "write_csv",
    "write_table",
]
