"""Aggregate tables handed to dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.operators.marts import COVERAGE_RATES, CORE_MEASURES, DQ_RATES, MONTHLY_MEASURES

# The fields that a dashboard reads from each export, by their output names. Rates
# are left out and recomputed from sums.
MONTHLY_FIELDS = ["as_of_month", *MONTHLY_MEASURES]
SEGMENT_FIELDS = [
    "as_of_month",
    "segment_name",
    "segment_value",
    "privacy_merged",
    "source_mart_row_count",
    *CORE_MEASURES,
    "segment_sort_order",
]
TRANSITION_FIELDS = [
    "from_month",
    "to_month",
    "from_state",
    "to_state",
    "privacy_merged",
    "source_mart_row_count",
    "transition_loan_count",
    "transition_from_upb",
    "from_state_sort_order",
    "to_state_sort_order",
]


def export_monthly(mart: DataFrame) -> DataFrame:
    """Monthly mart in export column order."""
    return mart.select(*MONTHLY_FIELDS, *COVERAGE_RATES, *DQ_RATES)


def in_display_order(export: DataFrame) -> DataFrame:
    """Rows in the order a reader expects; absent positions come last."""
    for keys in (
        ["as_of_month", "segment_name", "segment_sort_order", "segment_value"],
        ["from_month", "from_state_sort_order", "to_state_sort_order", "to_state"],
        ["as_of_month"],
    ):
        if set(keys) <= set(export.columns):
            return export.orderBy(*(F.col(key).asc_nulls_last() for key in keys))
    raise ValueError("not an export table")


def identifier_columns(table: DataFrame) -> list[str]:
    """Columns that would disclose loan identifiers."""
    return [name for name in table.columns if "loan_id" in name.lower()]
