"""Column helpers for quantities, costs and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed(amount: Column, trade_type: str = "transaction_type", strict: bool = False) -> Column:
    """``amount`` with the sign of its trade: BUY adds, anything else subtracts.

    ``strict`` lets only SELL subtract; other types give NULL, which sums skip.
    """
    kind = F.col(trade_type)
    out = F.when(kind == "BUY", amount)
    return out.when(kind == "SELL", -amount) if strict else out.otherwise(-amount)


def notional() -> Column:
    return F.col("quantity") * F.col("price")


def ratio(numerator: Column, denominator: Column) -> Column:
    """IEEE division of two numbers, NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(numerator: Column, denominator: Column) -> Column:
    """Percentage of a positive base, 0 where the base is not positive."""
    return F.when(denominator > 0, ratio(numerator, denominator) * 100).otherwise(F.lit(0.0))
