"""Time expressions (FN-5, FN-6, DEC-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def processing_time(at: dt.datetime | str | None = None) -> Column:
    """The processing stamp: local wall-clock time without zone, as every
    target stores it. Spark evaluates ``localtimestamp()`` once per query, so a
    micro-batch shares one value. ``at`` pins it (tests, oracle comparison,
    replays that must be byte-identical)."""
    if at is None:
        return F.localtimestamp()
    return ntz_literal(at)


def ntz_literal(value: dt.datetime | str) -> Column:
    """A zone-less timestamp literal. Built from text, so neither the Python
    process zone nor the session zone can shift it."""
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def to_millis(c: Column | str) -> Column:
    """Truncate a timestamp to milliseconds without touching the time zone
    (``date_trunc`` would round-trip a zone-less value through the session
    zone). Subtracts the sub-millisecond part of the seconds field."""
    c = F.col(c) if isinstance(c, str) else c
    sec = F.extract(F.lit("SECOND"), c)  # decimal(8,6): seconds with micros
    sub_ms = (sec * F.lit(1000) - F.floor(sec * F.lit(1000))) / F.lit(1000)
    return c - F.make_dt_interval(secs=sub_ms)
