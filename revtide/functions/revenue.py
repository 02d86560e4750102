"""Revenue expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["movement_type", "safe_ratio", "to_units", "count_true"]


def movement_type(before: str, after: str, event_type: str) -> str:
    """Revenue movement of one event as SQL text; both amounts are non-null cents."""
    return f"""case
        when {before} = 0 and {after} > 0
            then if({event_type} <=> 'reactivated', 'reactivation', 'new')
        when {before} > 0 and {after} > {before} then 'expansion'
        when {after} > 0 and {after} < {before} then 'contraction'
        when {before} > 0 and {after} = 0 then 'churn'
        else 'other' end"""


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is zero."""
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))


def to_units(cents: Column) -> Column:
    return cents / F.lit(100)


def count_true(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")
