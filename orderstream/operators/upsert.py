"""Last-arrival-wins per key (STR-6) and merging into a keyed snapshot
(SNK-2b).

Both are shuffles on the key, and both reduce map-side first: the
``row_number() = 1`` filter is planned with a partial ``WindowGroupLimit``
before the exchange, and the merge is a two-phase aggregate. A key that holds
a third of all rows therefore leaves each map task as one row, never as a
third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KEY, UPDATE_COLUMNS


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, key: str | Sequence[str] = KEY, order: str | Sequence[str] = ("offset",)) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (arrival order,
    not order time: a late-arriving older order still wins). ``order`` must be
    a total order within a key, e.g. ``(offset, line)``."""
    w = Window.partitionBy(*_as_list(key)).orderBy(*[F.col(c).desc() for c in _as_list(order)])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def upsert_snapshot(
    current: DataFrame,
    batch: DataFrame,
    *,
    key: str = KEY,
    columns: Sequence[str] = UPDATE_COLUMNS,
    order: str | Sequence[str] = "offset",
    created: str = "created_at",
    created_value: Column | None = None,
) -> DataFrame:
    """Apply ``batch`` to ``current`` as keyed upserts.

    For each key the result carries the last arrival's ``columns`` (batch rows
    after current rows, within the batch by ``order``, a total arrival order
    such as ``(offset, line)``), and ``created`` from the first arrival: an
    existing row keeps its value; a new key takes ``created_value`` of its
    earliest batch row (default: its processing time). Replaying the same
    batch gives the same table.

    One two-phase aggregate on the key over both sides: the batch is read once,
    and reduced within each task before the shuffle.
    """
    return _merge(current, batch, key, columns, order, created, created_value)


def _merge(current, batch, key, columns, order, created, created_value) -> DataFrame:
    cols = list(columns)
    created_value = created_value if created_value is not None else F.col("processing_timestamp")
    arrival = F.struct(*[F.col(c) for c in _as_list(order)])
    arrival_type = batch.select(arrival.alias("a")).schema["a"].dataType
    cur = current.select(
        F.col(key), *[F.col(c) for c in cols], F.col(created),
        F.struct(F.lit(0).alias("src"), F.lit(None).cast(arrival_type).alias("ord")).alias("_rank"),
    )
    new = batch.select(
        F.col(key), *[F.col(c) for c in cols], created_value.alias(created),
        F.struct(F.lit(1).alias("src"), arrival.alias("ord")).alias("_rank"),
    )
    merged = cur.unionByName(new).groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("_rank")).alias("_last"),
        F.min_by(F.col(created), F.col("_rank")).alias(created),
    )
    return merged.select(F.col(key), *[F.col(f"_last.{c}").alias(c) for c in cols], F.col(created))


def empty_snapshot(batch: DataFrame, *, key: str = KEY, columns: Sequence[str] = UPDATE_COLUMNS, created: str = "created_at") -> DataFrame:
    """A zero-row snapshot with the shape ``upsert_snapshot`` produces (the
    state of a keyed table before its first batch)."""
    schema = batch.select(F.col(key), *[F.col(c) for c in columns], F.lit(None).cast("timestamp_ntz").alias(created)).schema
    return batch.sparkSession.createDataFrame([], schema)
