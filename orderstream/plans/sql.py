"""The enrichment step as SQL text over a view of raw orders (API-3, SNK-3).

Same options and result as the DataFrame form (``enrich``), and the same
constraint check before a sink.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.money import ROUNDING_MODES
from ..operators.quality import split_valid
from ..schemas import PROCESSED_COLUMNS

_COUNT = "try_cast(quantity AS DECIMAL(10,0))"
_UNROUNDED = f"try_multiply({_COUNT}, try_cast(price AS DECIMAL(18,6)))"
_TOTALS = {
    "exact": f"try_multiply({_COUNT}, try_cast(price AS DECIMAL(10,2)))",
    "half_up": f"round({_UNROUNDED}, 2)",
    "half_even": f"bround({_UNROUNDED}, 2)",
    "scaled": f"floor({_UNROUNDED} * 100 + 0.5) / 100",
}


def processing_sql(at: dt.datetime | str | None) -> str:
    if at is None:
        return "localtimestamp()"
    if isinstance(at, dt.datetime):
        at = at.replace(tzinfo=None).isoformat(sep=" ")
    return f"TIMESTAMP_NTZ '{at}'"


def _millis(column: str) -> str:
    return f"{column} - make_dt_interval(0, 0, 0, (extract(SECOND FROM {column}) * 1000 % 1) / 1000)"


def enrich_sql_text(
    source: str,
    at: dt.datetime | str | None = None,
    keep: tuple[str, ...] = (),
    *,
    rounding: str = "exact",
    ts_precision: str = "us",
    null_status: str = "keep",
) -> str:
    """The enrichment SELECT over ``source`` with the options of ``enrich``;
    ``keep`` columns pass through in front (e.g. ``offset`` for a keyed sink)."""
    if rounding not in ROUNDING_MODES:
        raise ValueError(f"unknown rounding mode {rounding!r}; expected one of {ROUNDING_MODES}")
    made = {
        "price": "try_cast(price AS DECIMAL(10,2))",
        "total_price": f"try_cast({_TOTALS[rounding]} AS DECIMAL(10,2))",
        "processing_timestamp": processing_sql(at),
        "status": "upper(status)",
    }
    if ts_precision == "ms":
        made["order_timestamp"] = _millis("order_timestamp")
        made["processing_timestamp"] = _millis(processing_sql(at))
    columns = [*keep, *(f"{made[c]} AS {c}" if c in made else c for c in PROCESSED_COLUMNS)]
    where = "\nWHERE status IS NOT NULL" if null_status == "drop" else ""
    return "SELECT\n    " + ",\n    ".join(columns) + f"\nFROM {source}{where}"


def enrich_sql(spark: SparkSession, raw: DataFrame, at: dt.datetime | str | None = None, view: str | None = None, **options) -> DataFrame:
    """Register ``raw`` under a view name and run the enrichment SQL on it."""
    view = view or f"orders_raw_{uuid.uuid4().hex[:8]}"
    raw.createOrReplaceTempView(view)
    return spark.sql(enrich_sql_text(view, at, **options))


def insert_into(spark: SparkSession, select_sql: str, target: str, columns: tuple[str, ...] | None = None) -> None:
    """``INSERT INTO target [(columns)] <select>`` against a catalog table
    (batch). Columns left out take the table's declared defaults."""
    cols = f" ({', '.join(columns)})" if columns else ""
    spark.sql(f"INSERT INTO {target}{cols} {select_sql}")


def insert_into_keyed(spark: SparkSession, select_sql: str, table, batch_id: int, created_value=None) -> DataFrame:
    """The SQL sink with a declared key: the valid rows of ``select_sql`` are
    upserted into ``table`` (a ``KeyedTable``) as batch ``batch_id``; the select
    must carry the arrival-order column the table orders by. Returns the rows that
    break a constraint (a missing key, for one), with their reasons."""
    valid, rejected = split_valid(spark.sql(select_sql))
    table.write_batch(valid, batch_id, created_value)
    return rejected
