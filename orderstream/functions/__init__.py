"""Column-level functions: each returns a ``Column`` built from Spark built-ins."""

from .codec import ISO_MICROS, encode_json
from .money import ROUNDING_MODES, round_money, to_money, total_price
from .text import audit_line, encode_key, upper_status
from .time import processing_time, to_millis

__all__ = [
    "ISO_MICROS",
    "ROUNDING_MODES",
    "audit_line",
    "encode_json",
    "encode_key",
    "processing_time",
    "round_money",
    "to_millis",
    "to_money",
    "total_price",
    "upper_status",
]
