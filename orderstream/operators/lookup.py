"""Reads of a processed table (FLT-4..7). Plain filters: on a parquet table
they reach the scan as ``PushedFilters`` (or ``PartitionFilters`` when the
table is partitioned by status)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ntz_literal
from ..schemas import PROCESSED_COLUMNS


def peek(df: DataFrame, n: int = 10, order_by: Sequence[str] = PROCESSED_COLUMNS) -> DataFrame:
    """First ``n`` rows under a total order; planned as a per-partition top-n
    (``TakeOrderedAndProject``), never a full sort."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)


def by_customer(df: DataFrame, customer_id: str) -> DataFrame:
    return df.filter(F.col("customer_id") == F.lit(customer_id))


def by_order_time(df: DataFrame, lo: dt.datetime | str, hi: dt.datetime | str) -> DataFrame:
    """Half-open range ``lo <= order_timestamp < hi`` (zone-less bounds)."""
    lo_c, hi_c = ntz_literal(lo), ntz_literal(hi)
    return df.filter((F.col("order_timestamp") >= lo_c) & (F.col("order_timestamp") < hi_c))


def by_status(df: DataFrame, status: str) -> DataFrame:
    return df.filter(F.col("status") == F.lit(status))
