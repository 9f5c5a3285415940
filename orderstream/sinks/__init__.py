"""Sinks: file tables (sorted append, keyed log, dead letters), JDBC, topic."""

from .files import KeyedTable, append_sorted, ensure_tables, fold_log, register_keyed, tables, write_rejected
from .jdbc import append_jdbc, upsert_jdbc, upsert_statement, with_retries
from .topic import publish, topic_records

__all__ = [
    "KeyedTable",
    "append_jdbc",
    "append_sorted",
    "ensure_tables",
    "fold_log",
    "publish",
    "register_keyed",
    "tables",
    "topic_records",
    "upsert_jdbc",
    "upsert_statement",
    "with_retries",
    "write_rejected",
]
