"""Money arithmetic. Amounts become decimals before they are added, so sums are exact in any order, also of
fractions of a cent; only what the source rounds is rounded, once and after adding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,10)"


def exact(amount: Column) -> Column:
    return amount.cast(MONEY)


def money_sum(amount: Column) -> Column:
    return F.sum(exact(amount)).cast("double")


def round2(x: Column) -> Column:
    """Two decimals, halves towards plus infinity."""
    return F.floor(x * 100 + 0.5) / F.lit(100.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
