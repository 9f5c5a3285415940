"""JSON encoding of orders (FN-11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS

# Fixed value: the ISO-8601 local format with six fraction digits that the
# producer writes.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode_json(columns: tuple[str, ...] = RAW_COLUMNS) -> Column:
    """One JSON object per row with the given fields. Timestamps keep all six
    fraction digits (Spark's default would cut them to milliseconds); NULL
    fields are omitted, which a decoder reads back as NULL."""
    return F.to_json(
        F.struct(*[F.col(c) for c in columns]),
        {"timestampNTZFormat": ISO_MICROS, "timestampFormat": ISO_MICROS},
    )
