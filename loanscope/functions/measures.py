"""Additive measures, rates and labels.

Helpers used for whole lists of columns return SQL text, so that a wide select
is built in one call; the others return columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money totals all share one type, whatever depth of re-summing produced them.
TOTAL = "decimal(38,2)"


def total(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def total_where(condition: str, amount: str) -> str:
    """Sum of the amounts for which the condition is true; 0 if there are none."""
    return f"cast(coalesce(sum({amount}) FILTER (WHERE {condition}), 0) AS {TOTAL})"


def count_total_where(condition: str, count: str) -> str:
    """The same for pre-counted rows."""
    return f"cast(coalesce(sum({count}) FILTER (WHERE {condition}), 0) AS bigint)"


def rate(numerator: str, denominator: str) -> str:
    """Share in double precision, NULL on a zero denominator."""
    return f"double({numerator}) / nullif(double({denominator}), 0)"


def banded(value: str, bands: Sequence[tuple[int | None, str]], unknown: str) -> str:
    """Label of the first band whose upper edge is not below the value."""
    closed = " ".join(f"WHEN {value} <= {upper} THEN '{name}'" for upper, name in bands if upper)
    last = next(name for upper, name in bands if upper is None)
    return f"CASE WHEN {value} IS NULL THEN '{unknown}' {closed} ELSE '{last}' END"


def ranked(value: str, order: dict[str, int], default: int) -> str:
    """Display position of a label."""
    places = " ".join(f"WHEN '{name}' THEN {place}" for name, place in order.items())
    return f"CASE {value} {places} ELSE {default} END"
