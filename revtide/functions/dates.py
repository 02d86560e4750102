"""Calendar expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["month_of", "day_of", "add_months", "month_label"]


def month_of(ts: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(ts), "month")


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def add_months(day: Column, n: int) -> Column:
    return F.add_months(day, n)


def month_label(day: Column, pattern: str = "MMM yyyy") -> Column:
    return F.date_format(day, pattern)
