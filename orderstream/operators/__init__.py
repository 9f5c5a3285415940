"""DataFrame -> DataFrame operators. Each works on a batch or a streaming
DataFrame unless its docstring says it needs a batch (the key-based ones run
inside ``foreachBatch``)."""

from .decode import MODES, annotate, decode_json, decode_utf8, decode_with, malformed, split_rows
from .enrich import enrich, to_processed, with_audit_line, with_defaults, with_engine_tag
from .lookup import by_customer, by_order_time, by_status, peek
from .quality import drop_failed, is_valid, reject_reasons, split_valid, with_reasons
from .upsert import empty_snapshot, latest_per_key, upsert_snapshot

__all__ = [
    "MODES",
    "annotate",
    "by_customer",
    "by_order_time",
    "by_status",
    "decode_json",
    "decode_utf8",
    "decode_with",
    "drop_failed",
    "empty_snapshot",
    "enrich",
    "is_valid",
    "latest_per_key",
    "malformed",
    "peek",
    "reject_reasons",
    "split_rows",
    "split_valid",
    "to_processed",
    "upsert_snapshot",
    "with_audit_line",
    "with_defaults",
    "with_engine_tag",
    "with_reasons",
]
