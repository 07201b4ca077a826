"""Dashboard panels over the exported aggregates.

Rates are always recomputed from summed numerators and denominators. Labels are
matched by equality, also those that start with a comparison sign.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.domain import (
    DESTINATION_STATES,
    MIN_CELL_COUNT,
    OPEN_STATES,
    OTHER_SEGMENT,
    SEGMENT_BANDS,
    VINTAGES,
)
from loanscope.functions.measures import TOTAL, rate, total
from loanscope.operators.marts import CORE_MEASURES, COVERAGE_RATES, DQ_RATES, rate_columns

MonthValue = str


def _is_month(column: str, month: MonthValue) -> Column:
    return F.col(column) == F.lit(month).cast("date")


def _or_zero(column: str) -> Column:
    amount = F.col(column)
    zero = F.lit(0).cast(TOTAL if column.endswith("upb") else "bigint")
    return F.coalesce(amount, zero).alias(column)


def _summed(columns: Iterable[str]) -> list[Column]:
    return [(total(F.col(c)) if c.endswith("upb") else F.sum(c)).alias(c) for c in columns]


def _domain(spark: SparkSession, name: str, labels: Iterable[str]) -> DataFrame:
    """A fixed list of labels with their display position."""
    rows = ", ".join(f"({place}, '{label}')" for place, label in enumerate(labels, start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS domain(position, {name})")


def default_selection(monthly: DataFrame, transitions: DataFrame) -> DataFrame:
    """Latest month, latest origin month and the month after it."""
    latest = monthly.agg(F.max("as_of_month").alias("month")).select(
        "month", F.lit(None).cast("date").alias("from_month")
    )
    latest_from = transitions.agg(F.max("from_month").alias("from_month")).select(
        F.lit(None).cast("date").alias("month"), "from_month"
    )
    return (
        latest.unionByName(latest_from)
        .agg(F.max("month").alias("snapshot_month"), F.max("from_month").alias("from_month"))
        .select(
            "snapshot_month",
            "from_month",
            F.add_months("from_month", 1).alias("to_month"),
            F.date_format("snapshot_month", "yyyy-MM").alias("snapshot_label"),
        )
    )


def snapshot(monthly: DataFrame, month: MonthValue) -> DataFrame:
    """Headline figures of one month; a month without data shows zeros."""
    columns = CORE_MEASURES[:4]
    return (
        monthly.filter(_is_month("as_of_month", month))
        .agg(*_summed(columns))
        .select(*(_or_zero(c) for c in columns))
        .selectExpr("*", *rate_columns(COVERAGE_RATES))
    )


def trend(monthly: DataFrame) -> DataFrame:
    """Population and rates per month."""
    return monthly.selectExpr(
        "as_of_month", *CORE_MEASURES[:4], *rate_columns(COVERAGE_RATES), *rate_columns(DQ_RATES)
    )


def segment_panel(
    segments: DataFrame,
    month: MonthValue,
    dimension: str,
    k: int = MIN_CELL_COUNT,
    vintages: Iterable[int] = VINTAGES,
) -> DataFrame:
    """Fixed rows of one dimension in one month, zero where nothing is exported.

    Vintages are the named ones, without a merged row; :func:`segment_panel_in_full` shows
    what a month holds, whatever its labels.
    """
    if dimension == "origination_year":
        labels = [str(year) for year in vintages]
    else:
        labels = [*SEGMENT_BANDS[dimension], OTHER_SEGMENT]
    domain = _domain(segments.sparkSession, "segment_value", labels)
    return _segment_rows(segments, month, dimension, k, domain)


def segment_panel_in_full(
    segments: DataFrame, month: MonthValue, dimension: str, k: int = MIN_CELL_COUNT
) -> DataFrame:
    """One row per label that the month exports, so that the rows add up to the month.

    Labels stand in display order, the merged one last; ``position`` counts from 1.
    """
    of_month = segments.filter(
        _is_month("as_of_month", month) & (F.col("segment_name") == dimension)
    )
    merged = F.col("segment_value") == OTHER_SEGMENT
    order = (merged, F.col("segment_sort_order").asc_nulls_last(), "segment_value")
    # A month of a dimension has as many rows as labels.
    domain = of_month.select(
        F.row_number().over(Window.partitionBy("as_of_month").orderBy(*order)).alias("position"),
        "segment_value",
    )
    return _segment_rows(segments, month, dimension, k, domain)


def _segment_rows(
    segments: DataFrame, month: MonthValue, dimension: str, k: int, domain: DataFrame
) -> DataFrame:
    sums = (
        segments.filter(
            _is_month("as_of_month", month) & (F.col("segment_name") == dimension)
        )
        .groupBy("segment_value")
        .agg(*_summed(CORE_MEASURES))
    )
    note = f"if(segment_value = '{OTHER_SEGMENT}', 'Merged to minimum {k}', '')"
    return (
        domain.join(sums, "segment_value", "left")
        .select("position", "segment_value", *(_or_zero(c) for c in CORE_MEASURES))
        .selectExpr(
            "position",
            "segment_value",
            *CORE_MEASURES[:4],
            *rate_columns(COVERAGE_RATES),
            *rate_columns(DQ_RATES),
            f"{note} AS low_volume_note",
        )
    )


_FLOWS = ["transition_loan_count", "transition_from_upb"]


def focus_state(transitions: DataFrame, month: MonthValue, state: str) -> DataFrame:
    """Observable loans, origin balance and number of destinations of one state."""
    return (
        transitions.filter(_is_month("from_month", month) & (F.col("from_state") == state))
        .agg(*_summed(_FLOWS), F.count("*").alias("visible_destinations"))
        .select(*(_or_zero(c) for c in _FLOWS), "visible_destinations")
    )


def cohorts(transitions: DataFrame, month: MonthValue) -> DataFrame:
    """Observable loans and origin balance per state of origin."""
    sums = (
        transitions.filter(_is_month("from_month", month))
        .groupBy("from_state")
        .agg(*_summed(_FLOWS))
    )
    return (
        _domain(transitions.sparkSession, "from_state", OPEN_STATES)
        .join(sums, "from_state", "left")
        .select("position", "from_state", *(_or_zero(c) for c in _FLOWS))
    )


def _flow_sums(weight: str) -> list[Column]:
    """Sum per destination (``<weight>_1`` and on) and over all of them."""
    sums = [F.expr(f"cast(sum({weight}) AS {TOTAL}) AS {weight}_all")]
    for place, state in enumerate(DESTINATION_STATES, start=1):
        chosen = f"sum({weight}) FILTER (WHERE to_state = '{state}')"
        sums.append(F.expr(f"cast(coalesce({chosen}, 0) AS {TOTAL}) AS {weight}_{place}"))
    return sums


def _share(weight: str, place: int) -> str:
    return rate(f"{weight}_{place}", f"{weight}_all")


def migration_matrix(transitions: DataFrame, month: MonthValue, weight: str) -> DataFrame:
    """Share of each destination (columns) per state of origin (rows).

    ``weight`` is the flow column: loan count or origin balance. A state whose
    cohort is not exported has a blank row; an unobserved destination is 0.
    """
    if weight not in _FLOWS:
        raise ValueError(f"weight must be one of {_FLOWS}")
    sums = (
        transitions.filter(_is_month("from_month", month))
        .groupBy("from_state")
        .agg(*_flow_sums(weight))
    )
    return (
        _domain(transitions.sparkSession, "from_state", OPEN_STATES)
        .join(sums, "from_state", "left")
        .selectExpr(
            "position",
            "from_state",
            *(
                f"{_share(weight, place)} AS `{state}`"
                for place, state in enumerate(DESTINATION_STATES, start=1)
            ),
        )
    )


def destination_mix(transitions: DataFrame, month: MonthValue, state: str) -> DataFrame:
    """Count and balance share of every destination of one state."""
    loans, upb = _FLOWS
    sums = transitions.filter(
        _is_month("from_month", month) & (F.col("from_state") == state)
    ).agg(*_flow_sums(loans), *_flow_sums(upb))
    rows = ", ".join(
        f"{place}, '{name}', {_share(loans, place)}, {_share(upb, place)}"
        for place, name in enumerate(DESTINATION_STATES, start=1)
    )
    return sums.selectExpr(
        f"stack({len(DESTINATION_STATES)}, {rows})"
        " AS (position, to_state, count_rate, balance_rate)"
    )
