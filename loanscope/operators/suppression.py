"""Small-cell suppression of the segment and transition marts.

Inputs are marts: months x labels, a size set by the calendar and the label
lists and not by the number of loans. Window partitions are one month and
dimension (or one month and origin state), a few dozen rows each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscope.domain import (
    MIN_CELL_COUNT,
    OTHER_DESTINATION,
    OTHER_DESTINATION_ORDER,
    OTHER_SEGMENT,
    SEGMENT_BANDS,
    STATE_ORDER,
    TERMINATED_ORDER,
    UNRANKED_SEGMENT_ORDER,
)
from loanscope.functions.measures import ranked, total
from loanscope.operators.marts import (
    CORE_MEASURES,
    COVERAGE_RATES,
    DQ_RATES,
    TRANSITION_RATES,
    rate_columns,
)


def require_threshold(k: int) -> None:
    if k < 2:
        raise ValueError("the minimum cell count must be at least 2")


def mark_merged(mart: DataFrame, within: list[str], label: str, count: str, k: int) -> DataFrame:
    """Flag (``privacy_merged``) the cells that must go into the merged bucket.

    A cell is merged when it holds fewer than k loans. If the merged cells of a
    group would together still hold 1 to k-1 loans, the smallest safe cell joins
    them (ties go to the first label), so no small total can be derived by
    subtraction.
    """
    low = F.col(count) < k
    group = Window.partitionBy(*within)
    smallest_safe_first = group.orderBy(low, F.col(count), F.col(label))
    low_total = F.sum(F.when(low, F.col(count)).otherwise(0)).over(group)
    rank = F.row_number().over(smallest_safe_first)
    needs_company = low_total.between(1, k - 1) & (rank == 1)
    return mart.withColumn("privacy_merged", low | needs_company)


def _roll(
    marked: DataFrame, key: list[str], label: str, bucket: str, sums: list[Column]
) -> DataFrame:
    shown = F.when(F.col("privacy_merged"), bucket).otherwise(F.col(label))
    return (
        marked.withColumn(label, shown)
        .groupBy(*key)
        .agg(
            F.bool_or("privacy_merged").alias("privacy_merged"),
            F.count("*").alias("source_mart_row_count"),
            *sums,
        )
    )


def _add_up(column: str) -> Column:
    added = total(F.col(column)) if column.endswith("upb") else F.sum(column)
    return added.alias(column)


def segment_sort_order() -> str:
    """Display position: the year itself for vintages, the band's place otherwise.

    A merged vintage bucket has no position (NULL); other merged buckets are last.
    """
    cases = ["WHEN segment_name = 'origination_year' THEN try_cast(segment_value AS int)"]
    for segment, labels in SEGMENT_BANDS.items():
        places = {label: place for place, label in enumerate(labels, start=1)}
        position = ranked("segment_value", places, UNRANKED_SEGMENT_ORDER)
        cases.append(f"WHEN segment_name = '{segment}' THEN {position}")
    return f"CASE {' '.join(cases)} ELSE {UNRANKED_SEGMENT_ORDER} END AS segment_sort_order"


def suppress_segments(mart: DataFrame, k: int = MIN_CELL_COUNT, strict: bool = False) -> DataFrame:
    """Segment mart with small cells merged per month and dimension.

    Where a whole month and dimension holds fewer than k loans the merged bucket
    itself stays below k; ``strict`` leaves such buckets out.
    """
    require_threshold(k)
    key = ["as_of_month", "segment_name", "segment_value"]
    marked = mark_merged(mart, key[:2], "segment_value", "on_book_loan_count", k)
    rolled = _roll(
        marked, key, "segment_value", OTHER_SEGMENT, [_add_up(m) for m in CORE_MEASURES]
    )
    if strict:
        rolled = rolled.filter(F.col("on_book_loan_count") >= k)
    return rolled.selectExpr(
        "*", *rate_columns(COVERAGE_RATES), *rate_columns(DQ_RATES), segment_sort_order()
    )


def suppress_transitions(mart: DataFrame, k: int = MIN_CELL_COUNT) -> DataFrame:
    """All-loan transitions without cohorts below k and with rare destinations merged.

    Denominators stay those of the full cohort, so exported rates still add to one.
    """
    require_threshold(k)
    cohort = ["from_month", "from_state"]
    over_cohort = Window.partitionBy(*cohort)
    retained = (
        mart.filter(F.col("segment_name") == "all")
        .withColumns(
            {
                "observable_from_state_loan_count": F.sum("transition_loan_count").over(over_cohort),
                "observable_from_state_upb": F.sum("transition_from_upb").over(over_cohort),
            }
        )
        .filter(F.col("observable_from_state_loan_count") >= k)
    )
    rolled = _roll(
        mark_merged(retained, cohort, "to_state", "transition_loan_count", k),
        ["from_month", "to_month", "from_state", "to_state"],
        "to_state",
        OTHER_DESTINATION,
        [
            _add_up("transition_loan_count"),
            _add_up("transition_from_upb"),
            F.max("observable_from_state_loan_count").alias("observable_from_state_loan_count"),
            F.max("observable_from_state_upb")
            .cast("decimal(38,2)")
            .alias("observable_from_state_upb"),
        ],
    )
    destination_order = STATE_ORDER | {OTHER_DESTINATION: OTHER_DESTINATION_ORDER}
    return rolled.selectExpr(
        "*",
        *rate_columns(TRANSITION_RATES),
        f"{ranked('from_state', STATE_ORDER, TERMINATED_ORDER)} AS from_state_sort_order",
        f"{ranked('to_state', destination_order, TERMINATED_ORDER)} AS to_state_sort_order",
    )
