"""Store constraints as predicates (FLT-1..3, SNK-10).

The targets declare NOT NULL, VARCHAR lengths, DECIMAL(10,2) and an unsigned
quantity; one violating row would fail a whole JDBC batch (or stop a stream).
So every row is checked before a sink, and violators go to a rejected output
with their reasons instead of being printed and lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ENGINE_TAG, ENGINE_TAG_MAX_LENGTH, MAX_ID_LENGTH, MAX_STATUS_LENGTH, REQUIRED_COLUMNS

REASONS = "reject_reasons"


def reject_reasons(required: Sequence[str] = REQUIRED_COLUMNS, tagged: bool = False) -> Column:
    """Comma-separated reasons, empty for a valid row. Fixed order: the NULL
    checks in column order, then lengths, then sign; ``tagged`` adds the length
    of the engine tag."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c}:null")) for c in required]
    for c in ("order_id", "customer_id", "product_id"):
        checks.append(F.when(F.length(c) > MAX_ID_LENGTH, F.lit(f"{c}:too_long")))
    checks.append(F.when(F.length("status") > MAX_STATUS_LENGTH, F.lit("status:too_long")))
    checks.append(F.when(F.col("quantity") < 0, F.lit("quantity:negative")))
    if tagged:
        checks.append(F.when(F.length(ENGINE_TAG) > ENGINE_TAG_MAX_LENGTH, F.lit(f"{ENGINE_TAG}:too_long")))
    return F.concat_ws(",", *checks)


def is_valid(required: Sequence[str] = REQUIRED_COLUMNS, tagged: bool = False) -> Column:
    """True when a row satisfies every store constraint; never NULL (the NOT
    NULL checks come first, so a NULL column makes the conjunction false)."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    for c in ("order_id", "customer_id", "product_id"):
        cond = cond & (F.length(c) <= MAX_ID_LENGTH)
    cond = cond & (F.length("status") <= MAX_STATUS_LENGTH)
    if tagged:
        cond = cond & (F.coalesce(F.length(ENGINE_TAG), F.lit(0)) <= ENGINE_TAG_MAX_LENGTH)
    return cond & (F.col("quantity") >= 0)


def with_reasons(df: DataFrame, column: str = REASONS) -> DataFrame:
    return df.withColumn(column, reject_reasons(tagged=ENGINE_TAG in df.columns))


def split_valid(df: DataFrame, column: str = REASONS) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; only ``rejected`` builds the reasons string, the
    valid side is a plain predicate. When both are written, persist the input
    first (as the batch jobs do) so it is computed once."""
    ok = is_valid(tagged=ENGINE_TAG in df.columns)
    return df.filter(ok), with_reasons(df.filter(~ok), column)


def drop_failed(df: DataFrame, columns: Sequence[str] = ("total_price", "order_timestamp")) -> DataFrame:
    """Drop records whose decode or transform left a required derived value
    NULL (the stream jobs' ``filter(x is not None)``)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)
