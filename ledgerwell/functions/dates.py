"""Month arithmetic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: pay received up to this day belongs to the month before.
LAST_EARLY_PAYDAY = 16


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def accrual_month(date: Column, category: Column, early_categories: Iterable[str]) -> Column:
    """Month in which the money was earned rather than received."""
    early = category.isin(*early_categories) & (F.dayofmonth(date) <= LAST_EARLY_PAYDAY)
    return F.when(early, F.add_months(month_start(date), -1)).otherwise(month_start(date))
