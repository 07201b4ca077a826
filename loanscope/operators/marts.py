"""Portfolio, segment and transition marts.

Large inputs are reduced in two steps. The first groups loan-months by the few
coarse attributes the measures look at and keeps one count and one balance, so
each row updates two running totals instead of twenty; the second derives every
measure from that small table. Group keys are months and low-cardinality
labels, so map-side partial aggregation absorbs skew before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscope.domain import SEGMENTS, TERMINATED_PREFIX
from loanscope.functions.measures import TOTAL, count_total_where, rate, total, total_where

# population -> condition over the coarse loan-month attributes
CORE_POPULATIONS = {
    "on_book": "is_on_book_eom",
    "delinquency_eligible": "is_delinquency_eligible",
    "dq30": "is_delinquency_eligible AND delinquency_months >= 1",
    "dq60": "is_delinquency_eligible AND delinquency_months >= 2",
    "dq90": "is_delinquency_eligible AND delinquency_months >= 3",
}
EXCLUDED_POPULATIONS = {
    "excluded_pre_due": "is_on_book_eom AND is_pre_due",
    "excluded_loan_age_zero": "is_on_book_eom AND loan_age = 0",
    "excluded_invalid_loan_age": "is_on_book_eom AND (loan_age IS NULL OR loan_age < 0)",
    "excluded_non_numeric_status": (
        "is_on_book_eom AND loan_age >= 1 AND NOT is_numeric_delinquency_status"
    ),
}

_ELIGIBLE_MEASURES = ["delinquency_eligible_loan_count", "delinquency_eligible_upb"]
_DQ_MEASURES = [
    *(f"dq{d}_loan_count" for d in (30, 60, 90)),
    *(f"dq{d}_upb" for d in (30, 60, 90)),
]
CORE_MEASURES = ["on_book_loan_count", "on_book_upb", *_ELIGIBLE_MEASURES, *_DQ_MEASURES]
EXCLUDED_MEASURES = [
    f"{population}_{unit}" for population in EXCLUDED_POPULATIONS for unit in ("loan_count", "upb")
]
MONTHLY_MEASURES = [*CORE_MEASURES[:4], *EXCLUDED_MEASURES, *_DQ_MEASURES]

COVERAGE_RATES = {
    "numeric_status_coverage_count_rate": (
        "delinquency_eligible_loan_count", "on_book_loan_count",
    ),
    "numeric_status_coverage_balance_rate": ("delinquency_eligible_upb", "on_book_upb"),
}
DQ_RATES = {
    **{
        f"dq{d}_count_rate": (f"dq{d}_loan_count", "delinquency_eligible_loan_count")
        for d in (30, 60, 90)
    },
    **{f"dq{d}_balance_rate": (f"dq{d}_upb", "delinquency_eligible_upb") for d in (30, 60, 90)},
}


def rate_columns(rates: dict[str, tuple[str, str]]) -> list[str]:
    return [f"{rate(*parts)} AS {name}" for name, parts in rates.items()]


# Panel attributes cut down to the distinctions the measures make.
_COARSE = {
    "is_pre_due": "monitoring_state = 'PRE_DUE'",
    "delinquency_months": "if(delinquency_months >= 3, 3, int(delinquency_months))",
    "loan_age": "int(sign(loan_age))",
}


def _coarse(attributes: list[str]) -> list[str]:
    return [f"{_COARSE.get(name, name)} AS {name}" for name in attributes]


_CORE_ATTRIBUTES = ["is_on_book_eom", "is_delinquency_eligible", "delinquency_months"]
_ALL_ATTRIBUTES = [
    *_CORE_ATTRIBUTES, "is_numeric_delinquency_status", "is_pre_due", "loan_age",
]


def _cell_totals() -> list[Column]:
    return [
        F.count("*").alias("cell_count"),
        total(F.col("current_actual_upb")).alias("cell_upb"),
    ]


def _measures(populations: dict[str, str]) -> list[Column]:
    columns = []
    for name, condition in populations.items():
        columns.append(f"{count_total_where(condition, 'cell_count')} AS {name}_loan_count")
        columns.append(f"{total_where(condition, 'cell_upb')} AS {name}_upb")
    return [F.expr(column) for column in columns]


def portfolio_monthly(fact: DataFrame) -> DataFrame:
    """Portfolio measures, exclusion counts and rates per month."""
    cells = (
        fact.selectExpr("as_of_month", "current_actual_upb", *_coarse(_ALL_ATTRIBUTES))
        .groupBy("as_of_month", *_ALL_ATTRIBUTES)
        .agg(*_cell_totals())
    )
    populations = CORE_POPULATIONS | EXCLUDED_POPULATIONS
    return (
        cells.groupBy("as_of_month")
        .agg(*_measures(populations))
        .selectExpr(
            "as_of_month",
            *MONTHLY_MEASURES,
            *rate_columns(COVERAGE_RATES),
            *rate_columns(DQ_RATES),
        )
    )


def _segment_mart(cells: DataFrame) -> DataFrame:
    key = ["as_of_month", "segment_name", "segment_value"]
    return (
        cells.groupBy(*key)
        .agg(*_measures(CORE_POPULATIONS))
        .selectExpr(*key, *CORE_MEASURES, *rate_columns(DQ_RATES))
    )


def portfolio_by_segment(fact: DataFrame) -> DataFrame:
    """Core measures and delinquency rates per month and segment value.

    The four segment dimensions are independent cuts of the same loan-months,
    taken in one scan with grouping sets. The exchange carries at most
    months x (vintages + bands) x measure cells from each task, however many
    vintages the panel spans.
    """
    dimensions = list(SEGMENTS.values())
    shared = ["as_of_month", *_CORE_ATTRIBUTES]
    rows = fact.selectExpr(
        "as_of_month",
        *(f"string({column}) AS {column}" for column in dimensions),
        "current_actual_upb",
        *_coarse(_CORE_ATTRIBUTES),
    )
    cells = rows.groupingSets(
        [[*shared, dimension] for dimension in dimensions], *shared, *dimensions
    ).agg(*(F.expr(f"grouping({d}) AS {d}_absent") for d in dimensions), *_cell_totals())

    # A band column is NULL both where it is absent from the set and, on damaged
    # input, as a value; grouping() tells the two apart.
    name = " ".join(f"WHEN {c}_absent = 0 THEN '{s}'" for s, c in SEGMENTS.items())
    value = " ".join(f"WHEN {c}_absent = 0 THEN {c}" for c in dimensions)
    return _segment_mart(
        cells.selectExpr(
            f"CASE {name} END AS segment_name",
            f"CASE {value} END AS segment_value",
            *shared,
            "cell_count",
            "cell_upb",
        )
    )


def portfolio_by_segment_prereduced(fact: DataFrame) -> DataFrame:
    """The same mart, first reduced by all four dimensions together.

    Touches each row once, which is the faster form while the product of the
    dimensions stays small (few vintages); the first exchange grows with it.
    """
    dimensions = list(SEGMENTS.values())
    cells = (
        fact.selectExpr("as_of_month", *dimensions, "current_actual_upb", *_coarse(_CORE_ATTRIBUTES))
        .groupBy("as_of_month", *dimensions, *_CORE_ATTRIBUTES)
        .agg(*_cell_totals())
    )
    cuts = ", ".join(f"'{segment}', string({column})" for segment, column in SEGMENTS.items())
    return _segment_mart(
        cells.selectExpr(
            "as_of_month",
            *_CORE_ATTRIBUTES,
            "cell_count",
            "cell_upb",
            f"stack({len(SEGMENTS)}, {cuts}) AS (segment_name, segment_value)",
        )
    )


COHORT = ["from_month", "segment_name", "segment_value", "from_state"]
TRANSITION_RATES = {
    "transition_count_rate": ("transition_loan_count", "observable_from_state_loan_count"),
    "transition_balance_rate": ("transition_from_upb", "observable_from_state_upb"),
}


# A pair that is not what it should be, and the column that counts such pairs.
UNSOUND_PAIRS = {
    "pairs_not_adjacent": "to_month <> add_months(from_month, 1)",
    "pair_sources_off_book": f"from_upb <= 0 OR startswith(from_state, '{TERMINATED_PREFIX}')",
}


def monthly_flows(pairs: DataFrame) -> DataFrame:
    """Pairs reduced by months, vintage and states, and counts of unsound ones.

    Accepts plain pairs or weighted pairs (with ``pair_count``).
    """
    weight = "pair_count" if "pair_count" in pairs.columns else "1L"
    unsound = [
        F.expr(f"coalesce(sum({weight}) FILTER (WHERE {rule}), 0L) AS {name}")
        for name, rule in UNSOUND_PAIRS.items()
    ]
    return pairs.groupBy(
        "from_month", "to_month", "origination_year", "from_state", "to_state"
    ).agg(
        F.expr(f"sum({weight}) AS transition_loan_count"),
        total(F.expr(f"from_upb * {weight}")).alias("transition_from_upb"),
        *unsound,
    )


def transition_monthly(pairs: DataFrame) -> DataFrame:
    """Month-to-month flows between states, for all loans and per vintage.

    Accepts plain pairs or weighted pairs (with ``pair_count``). Pairs are
    reduced once with the vintage kept; both scopes come from that result.
    """
    return transitions_of(monthly_flows(pairs))


def transitions_of(by_vintage: DataFrame) -> DataFrame:
    """The transition mart from :func:`monthly_flows`."""
    scopes = "stack(2, 'all', 'All', 'origination_year', string(origination_year))"
    key = ["from_month", "to_month", "segment_name", "segment_value", "from_state", "to_state"]
    flows = (
        by_vintage.selectExpr("*", f"{scopes} AS (segment_name, segment_value)")
        .groupBy(*key)
        .agg(
            F.sum("transition_loan_count").alias("transition_loan_count"),
            total(F.col("transition_from_upb")).alias("transition_from_upb"),
        )
    )
    cohort = Window.partitionBy(*COHORT)
    with_cohorts = flows.select(
        *key,
        "transition_loan_count",
        "transition_from_upb",
        F.sum("transition_loan_count").over(cohort).alias("observable_from_state_loan_count"),
        F.sum("transition_from_upb").over(cohort).cast(TOTAL).alias("observable_from_state_upb"),
    )
    return with_cohorts.selectExpr("*", *rate_columns(TRANSITION_RATES))


#: Leading columns of the marts, by which each is stored in order.
KEYS = [
    ["from_month", "segment_name", "segment_value", "from_state", "to_state"],
    ["as_of_month", "segment_name", "segment_value"],
    ["as_of_month"],
]


def in_key_order(mart: DataFrame) -> DataFrame:
    """A mart sorted by its key."""
    key = next(key for key in KEYS if set(key) <= set(mart.columns))
    return mart.orderBy(*key)
