"""Enrichment: the processed order record (PRJ-1, PRJ-2, FN-1..10)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import to_money, total_price
from ..functions.text import audit_line, upper_status
from ..functions.time import processing_time, to_millis
from ..schemas import ENGINE_TAG_DEFAULT, PROCESSED_COLUMNS

NULL_STATUS = ("keep", "drop")


def enrich(
    df: DataFrame,
    *,
    rounding: str = "exact",
    at: dt.datetime | str | None = None,
    ts_precision: str = "us",
    null_status: str = "keep",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw order columns -> the nine processed columns, in target order.

    ``total_price`` = quantity x price as exact ``decimal(10,2)`` (NULL when it
    does not fit); ``processing_timestamp`` = one local wall-clock stamp per
    query (or ``at``); ``status`` upper-cased. ``ts_precision="ms"`` truncates
    both timestamps to milliseconds. ``null_status="drop"`` drops records
    without a status instead of keeping the NULL. ``keep`` columns pass through
    in front (e.g. ``offset`` for a later last-arrival-wins step).
    """
    if null_status not in NULL_STATUS:
        raise ValueError(f"null_status must be one of {NULL_STATUS}")
    if null_status == "drop":
        df = df.filter(F.col("status").isNotNull())
    order_ts = F.col("order_timestamp")
    proc_ts = processing_time(at)
    if ts_precision == "ms":
        order_ts, proc_ts = to_millis(order_ts), to_millis(proc_ts)
    return df.select(
        *[F.col(c) for c in keep],
        F.col("order_id"),
        F.col("customer_id"),
        F.col("product_id"),
        F.col("quantity"),
        to_money("price").alias("price"),  # the declared type, whatever the message schema
        total_price("quantity", "price", rounding).alias("total_price"),
        order_ts.alias("order_timestamp"),
        proc_ts.alias("processing_timestamp"),
        upper_status("status").alias("status"),
    )


def to_processed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Project exactly the processed columns in target order."""
    return df.select(*keep, *PROCESSED_COLUMNS)


def with_engine_tag(df: DataFrame, tag: str = ENGINE_TAG_DEFAULT, column: str = "spark_engine", from_status: bool = False) -> DataFrame:
    """Engine tag column. ``from_status=True`` reproduces the reference's
    placeholder (a copy of the status) instead of the table's default tag."""
    value = F.col("status").cast("string") if from_status else F.lit(tag)
    return df.withColumn(column, value)


def with_defaults(df: DataFrame, defaults: Mapping[str, object | Column]) -> DataFrame:
    """Fill column defaults the way an insert does: add a missing column with
    its default, and replace NULLs in an existing one."""
    out = {}
    for name, value in defaults.items():
        v = value if isinstance(value, Column) else F.lit(value)
        out[name] = F.coalesce(F.col(name), v) if name in df.columns else v
    return df.withColumns(out)


def with_audit_line(df: DataFrame, column: str = "audit_line") -> DataFrame:
    return df.withColumn(column, audit_line())
