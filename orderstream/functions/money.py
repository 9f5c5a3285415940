"""Money expressions: exact decimal line totals and the rounding rules the
different targets apply (FN-1, FN-2a..e, FN-3). All JVM-side column
expressions; nothing here leaves whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UNROUNDED

ROUNDING_MODES = ("exact", "half_up", "half_even", "scaled")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Narrowing cast to ``decimal(p,s)``; NULL instead of an error on overflow
    (ANSI mode would otherwise stop a stream on one bad record)."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def round_money(x: Column | str, mode: str = "half_up", scale: int = 2) -> Column:
    """Round a decimal expression to ``scale`` digits.

    * ``half_up``   - ties away from zero (Spark ``round``).
    * ``half_even`` - ties to even (``bround``); also the store dialect's rule.
    * ``scaled``    - ``floor(x * 10^s + 0.5) / 10^s``: ties toward +infinity.
    * ``exact``     - no rounding; the value must already fit.
    """
    x = _col(x)
    if mode == "half_up":
        return F.round(x, scale)
    if mode == "half_even":
        return F.bround(x, scale)
    if mode == "scaled":
        factor = F.lit(10**scale).cast("decimal(10,0)")
        return F.floor(x * factor + F.lit(0.5).cast("decimal(2,1)")) / factor
    if mode == "exact":
        return x
    raise ValueError(f"unknown rounding mode {mode!r}; expected one of {ROUNDING_MODES}")


def total_price(quantity: Column | str = "quantity", price: Column | str = "price", rounding: str = "exact") -> Column:
    """``quantity * price`` as ``decimal(10,2)``; NULL where it does not fit.

    ``exact`` multiplies the price as the store keeps it (two digits), so there
    is nothing to round. The other modes multiply the price as the message has
    it and round the product; only the result is narrowed. No step raises: a
    value out of range gives NULL for the quality check to reject."""
    count = _col(quantity).try_cast("decimal(10,0)")
    if rounding == "exact":
        return to_money(F.try_multiply(count, to_money(price)))
    # 18 whole and 6 fraction digits hold any product that can still fit.
    product = F.try_multiply(count, _col(price).try_cast(UNROUNDED))
    return to_money(round_money(product, rounding))
