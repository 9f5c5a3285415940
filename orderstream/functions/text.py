"""String expressions over orders (FN-4, FN-8, FN-10, FN-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_status(c: Column | str = "status") -> Column:
    """Upper-case status; NULL stays NULL."""
    return F.upper(F.col(c) if isinstance(c, str) else c)


# Fixed value: the audit line's wording.
AUDIT_PARTS = ("Processing: ", " | Status: ", " | Total: $")


def audit_line(order_id: str = "order_id", status: str = "status", total: str = "total_price") -> Column:
    """``Processing: <id> | Status: <s> | Total: $<t>`` as a column (printed
    per record by the original jobs; here it is data, written or observed). A
    missing part reads ``null``; the line is never NULL."""
    parts: list[Column] = []
    for label, value in zip(AUDIT_PARTS, (order_id, status, total), strict=True):
        parts += [F.lit(label), F.coalesce(F.col(value).cast("string"), F.lit("null"))]
    return F.concat(*parts)


def encode_key(c: Column | str = "order_id") -> Column:
    """Message key: UTF-8 bytes of the id; a NULL or empty id gives no key."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull() & (c != F.lit("")), F.encode(c, "UTF-8"))
