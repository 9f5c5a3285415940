"""Sources: the order topic (broker or files), stored tables, and the order
stand-ins derived from the driver's tables."""

from .standins import (
    EVENT_FAULTS,
    LINEITEM_FAULTS,
    as_topic,
    events_correction_topic,
    events_csv_topic,
    events_faulted_topic,
    events_shaped_topic,
    events_orders,
    events_topic,
    events_two_row_topic,
    lineitem_faulted_orders,
    lineitem_huge_topic,
    lineitem_net_topic,
    lineitem_orders,
    lineitem_topic,
)
from .tables import read_processed, read_processed_jdbc, read_table
from .topic import read_topic, read_topic_batch, read_topic_files, register_topic, value_only

__all__ = [
    "EVENT_FAULTS",
    "LINEITEM_FAULTS",
    "as_topic",
    "events_correction_topic",
    "events_csv_topic",
    "events_faulted_topic",
    "events_orders",
    "events_topic",
    "events_two_row_topic",
    "lineitem_faulted_orders",
    "lineitem_orders",
    "lineitem_topic",
    "read_processed",
    "read_processed_jdbc",
    "read_table",
    "read_topic",
    "read_topic_batch",
    "read_topic_files",
    "register_topic",
    "value_only",
]
