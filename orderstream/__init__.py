"""orderstream: order-message enrichment on Spark, batch or streaming.

Decode JSON order messages under a declared schema and an explicit policy for
malformed records, compute exact decimal totals, normalise status, stamp
processing time, separate valid from rejected rows, and write them as an
append-only sorted table or a keyed last-arrival-wins table.
"""

from . import functions, operators, plans, schemas, sinks, sources, streaming
from .operators import decode_json, enrich, latest_per_key, split_valid, upsert_snapshot
from .options import JdbcOptions, StreamOptions, TopicOptions
from .plans import PipelineOptions, process, process_split
from .sinks import KeyedTable, append_sorted
from .streaming import OrderBatchJob

__all__ = [
    "JdbcOptions",
    "KeyedTable",
    "OrderBatchJob",
    "PipelineOptions",
    "StreamOptions",
    "TopicOptions",
    "append_sorted",
    "decode_json",
    "enrich",
    "latest_per_key",
    "split_valid",
    "upsert_snapshot",
    "functions",
    "operators",
    "plans",
    "process",
    "process_split",
    "schemas",
    "sinks",
    "sources",
    "streaming",
]
