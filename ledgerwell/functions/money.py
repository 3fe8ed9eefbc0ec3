"""Exact decimal arithmetic; half cents round away from zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwell.schemas import MONEY, RATIO, TOTAL

def zero() -> Column:
    return F.lit(Decimal("0.00"))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def half(amount: Column) -> Column:
    return money(F.round(amount * F.lit(Decimal("0.50")), 2))


def total(amount: Column, when: Column | None = None) -> Column:
    """Sum of the amounts that meet a condition; the others add zero."""
    if when is not None:
        amount = F.when(when, amount).otherwise(zero())
    return F.sum(amount).cast(TOTAL)


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to four places, NULL for a zero denominator.

    Works on whole cents: decimal division drops digits once both sides are wide and would then round twice.
    The remainder goes before the division, which is then exact. A ratio of more than 28 digits before the
    point raises an error.
    """
    n = (F.abs(numerator.cast(TOTAL)) * 100).cast("decimal(28,0)")
    d = F.nullif((F.abs(denominator.cast(TOTAL)) * 100).cast("decimal(28,0)"), F.lit(0).cast("decimal(28,0)"))
    doubled = (n * F.lit(Decimal(20000)) + d).cast("decimal(38,0)")
    step = (d * F.lit(Decimal(2))).cast("decimal(38,0)")
    tenthousandths = ((doubled - doubled % step) / step).cast("decimal(33,0)")
    sign = F.when((numerator < 0) != (denominator < 0), F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")
    return (tenthousandths * sign * F.lit(Decimal("0.0001"))).cast(RATIO)
