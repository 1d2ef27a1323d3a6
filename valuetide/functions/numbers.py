"""Money and ratio arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def net_revenue(amount: str = "amount", refund: str = "refund_amount") -> Column:
    """Amount less refund in decimals, so that sums do not depend on order."""
    return F.col(amount).cast(MONEY) - F.col(refund).cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL where the divisor is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def logit(probability: Column) -> Column:
    """Log odds of a probability clipped to [1e-6, 1 - 1e-6]."""
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), probability))
    return F.log(p / (1 - p))


def non_negative_expm1(column: Column) -> Column:
    """Inverse of the log1p target, never below zero."""
    return F.greatest(F.lit(0.0), F.expm1(column))
