"""Texts shown in reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["money", "pct", "transition", "capitalized", "display_rank"]

# Characters used in report texts.
MINUS = "−"
DASH = "—"
ARROW = " → "


def money(units: Column, signed: bool = False) -> Column:
    """Whole dollars with thousands separators and a leading sign."""
    plus = F.lit("+" if signed else "")
    sign = F.when(units < 0, F.lit(MINUS)).when(units > 0, plus).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$"), F.format_number(F.abs(units), 0))


def pct(rate: Column) -> Column:
    """Percentage with one decimal, halves rounded away from zero."""
    tenths = F.round((rate * 100).cast("decimal(38,18)"), 1)
    return F.concat(tenths.cast("decimal(20,1)").cast("string"), F.lit("%"))


def transition(from_plan: Column, to_plan: Column, movement: Column) -> Column:
    def shown(plan: Column) -> Column:
        return F.when(plan != "", plan).otherwise(F.lit(DASH))

    target = F.when(movement == "churn", F.lit("canceled")).otherwise(shown(to_plan))
    return F.concat(shown(from_plan), F.lit(ARROW), target)


def capitalized(text: Column) -> Column:
    head = F.substring(text, 1, 1)
    return F.concat(F.upper(head), F.lower(F.substring(text, F.lit(2), F.length(text))))


def display_rank(text: Column, order: list[str]) -> Column:
    """1-based position of a label in a fixed order; null for any other label."""
    first, *rest = list(enumerate(order, start=1))
    return reduce(lambda acc, item: acc.when(text == item[1], item[0]), rest,
                  F.when(text == first[1], first[0]))
