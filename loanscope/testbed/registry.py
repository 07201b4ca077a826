"""Queries over the derived panel and the SQL that states their results."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from loanscope.domain import (
    DESTINATION_STATES,
    OPEN_STATES,
    ORIGINATION_FIELDS,
    PERFORMANCE_FIELDS,
    VINTAGES,
)
from loanscope.operators import (
    curated,
    disclosure,
    exports,
    loan_months,
    marts,
    panels,
    quality,
    raw_profile,
    suppression,
)
from loanscope.operators.export_quality import (
    DETAILS as EXPORT_DETAILS,
    dashboard_input_problems,
    export_results,
)
from loanscope.operators.staging import stage_performance
from loanscope.plans import build as build_plan
from loanscope.plans import dashboard
from loanscope.plans.raw_validation import profile_files, validate_raw
from loanscope.sources import delimited, storage
from loanscope.sources.csv_tables import read_csv, write_csv
from loanscope.testbed import dirty, panel
from loanscope.testbed.oracle import (
    BAND_PLACES,
    CORE,
    EXCLUDED,
    TWO_DIGITS,
    both_units,
    listed,
    statement,
)

Query = Callable[[SparkSession, str], DataFrame]

SNAPSHOT = "2023-05-01"
THIN_MONTH = "2025-11-01"
ABSENT_MONTH = "2030-01-01"

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def _comparable(table: DataFrame) -> DataFrame:
    """Amounts as doubles, the type both engines hand out alike."""
    return table.selectExpr(
        *(
            f"double(`{field.name}`) AS `{field.name}`"
            if isinstance(field.dataType, DecimalType)
            else f"`{field.name}`"
            for field in table.schema
        )
    )


def _register(name: str, query: Query, oracle: str | None = None) -> None:
    _queries[name] = lambda spark, sf_dir: _comparable(query(spark, sf_dir))
    if oracle is not None:
        _oracles[name] = oracle


# --- staging and curated --------------------------------------------------------

_PERF_MONEY = [
    "current_actual_upb", "current_non_interest_bearing_upb", "actual_loss",
    "bankruptcy_cramdown_costs",
]
_FLAGS = [
    "is_terminal_record", "is_on_book_eom", "is_numeric_delinquency_status",
    "is_delinquency_eligible", "monitoring_state",
]

_ORIG_COLUMNS = [
    "source_year", "loan_id", "origination_year", "origination_quarter", "classic_fico_raw",
    "classic_fico", "classic_fico_missing_reason", "first_payment_date_raw",
    "first_payment_month", "first_time_homebuyer_indicator", "maturity_date_raw",
    "maturity_month", "msa_or_metropolitan_division", "mi_percentage_raw", "mi_percentage",
    "number_of_units", "occupancy_status", "original_cltv_raw", "original_cltv",
    "original_dti_raw", "original_dti", "original_upb", "original_ltv_raw", "original_ltv",
    "original_interest_rate", "channel", "prepayment_penalty_indicator", "amortization_type",
    "property_state", "property_type", "postal_code", "loan_purpose", "original_loan_term",
    "number_of_borrowers", "seller_name", "vantage_score_4_raw", "vantage_score_4",
    "vantage_score_4_missing_reason",
]


def _doubles(columns: list[str], amounts: set[str]) -> str:
    return ", ".join(f"cast({c} as double) as {c}" if c in amounts else c for c in columns)


_register(
    "stage_origination",
    lambda s, d: panel.staged_origination(s, d).drop("source_file"),
    statement(
        "select "
        + _doubles(_ORIG_COLUMNS, {"original_upb", "original_interest_rate"})
        + "".join(f", nullif(o.{c}, '') as {c}" for c in panel.ORIGINATION_MORE)
        + " from orig join (select loan_id, " + ", ".join(panel.ORIGINATION_MORE)
        + " from orig_text) o using (loan_id)"
    ),
)

def _stage_performance_sql() -> str:
    more = [
        f"{panel.SETTLEMENT} as defect_settlement_date_raw",
        f"cast(try_strptime({panel.SETTLEMENT}, '%Y%m') as date) as defect_settlement_month",
        *(f"nullif({text}, '') as {c}" for c, text in panel.PERFORMANCE_MORE.items()),
        *(
            f"cast(nullif({text}, '') as double) as {c}"
            for c, text in panel.PERFORMANCE_AMOUNTS.items()
        ),
    ]
    return statement(
        f"""select source_year, loan_id, as_of_month,
            strftime(as_of_month, '%Y%m') as period_raw,
            cast(current_actual_upb as double) as current_actual_upb,
            delinquency_status_raw, delinquency_months,
            coalesce(cast(loan_age as varchar), '') as loan_age_raw, loan_age,
            cast(360 - mp % 83 as smallint) as remaining_months_to_legal_maturity,
            if(mp % 47 = 0, 'Y', null) as modification_flag, zero_balance_code,
            coalesce(strftime(zero_balance_effective_month, '%Y%m'), '')
                as zero_balance_effective_date_raw,
            zero_balance_effective_month,
            cast(k % 4 + 2 + 0.5 as double) as current_interest_rate,
            cast(0 as double) as current_non_interest_bearing_upb,
            strftime(as_of_month, '%Y%m') as ddlpi_raw, as_of_month as ddlpi_month,
            if(mp % 29 = 0, mp % 5000 + 0.25::double, null) as actual_loss,
            cast(mp % 90 + 10 as double) as estimated_ltv,
            'Servicer ' || (k % 10) as servicer_name,
            if(mp % 59 = 0, 12.5::double, null) as bankruptcy_cramdown_costs,
            {', '.join(_FLAGS)}, is_valid_loan_age,
            mp % 59 = 0 and zero_balance_code is null as dq_cramdown_populated_non_terminal,
            {', '.join(more)}
            from perf"""
    )


_register(
    "stage_performance",
    lambda s, d: stage_performance(panel.raw_performance(s, d)).drop("source_file"),
    _stage_performance_sql(),
)
_register(
    "monitoring_state",
    lambda s, d: panel.staged_performance(s, d)
    .groupBy(*_FLAGS, "is_valid_loan_age")
    .agg(F.count("*").alias("loan_months"), F.sum("current_actual_upb").alias("upb")),
    statement(
        f"""select {', '.join(_FLAGS)}, is_valid_loan_age, count(*) as loan_months,
            cast(sum(current_actual_upb) as double) as upb from perf group by all"""
    ),
)
_SENTINELS = [
    "classic_fico", "vantage_score_4", "mi_percentage", "original_cltv", "original_dti",
    "original_ltv",
]


def _sentinel_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = panel.staged_origination(spark, sf_dir)
    fields = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(f).alias("field"),
                    F.col(f"{f}_raw").alias("raw_value"),
                    F.col(f).alias("value"),
                )
                for f in _SENTINELS
            )
        )
    )
    return staged.select(fields.alias("f")).groupBy("f.field", "f.raw_value", "f.value").agg(
        F.count("*").alias("loans")
    )


_register(
    "sentinel_nulls",
    _sentinel_nulls,
    statement(
        " union all ".join(
            f"select '{f}' as field, {f}_raw as raw_value, {f} as value, count(*) as loans "
            "from orig group by all"
            for f in _SENTINELS
        )
    ),
)

_DIM_COLUMNS = [
    "loan_id", "origination_year", "origination_quarter", "first_payment_month", "maturity_month",
    "classic_fico", "fico_band", "original_cltv", "cltv_band", "original_ltv", "original_dti",
    "dti_band", "original_upb", "original_interest_rate", "original_loan_term", "property_state",
    "property_type", "occupancy_status", "loan_purpose", "channel", "source_year",
]
_FACT_COLUMNS = [
    "loan_id", "as_of_month", "origination_year", "origination_quarter", "fico_band", "cltv_band",
    "dti_band", "current_actual_upb", "delinquency_status_raw", "delinquency_months", "loan_age",
    "zero_balance_code", "zero_balance_effective_month", *_FLAGS, "source_year",
]
_register(
    "dim_loan",
    lambda s, d: curated.dim_loan(panel.staged_origination(s, d)).drop("source_file"),
    statement(
        "select " + _doubles(_DIM_COLUMNS, {"original_upb", "original_interest_rate"}) + " from dim"
    ),
)
_register(
    "fact_loan_month",
    lambda s, d: panel.fact(s, d).drop("source_file"),
    statement(f"select {listed(_FACT_COLUMNS)} from fact"),
)

_PAIRS_SQL = f"select {listed(curated.PAIR_COLUMNS)} from pairs"
_register(
    "next_month_pairs",
    lambda s, d: curated.next_month_pairs_ordered(panel.fact(s, d)),
    statement(_PAIRS_SQL),
)
_register(
    "next_month_pairs_join",
    lambda s, d: curated.next_month_pairs(panel.fact(s, d)),
    statement(_PAIRS_SQL),
)
_register(
    "next_month_pairs_repeated_keys",
    dirty.pairs,
    statement(
        f"select {listed(curated.PAIR_COLUMNS)}, count(*) as pair_count "
        "from pairs_joined group by all",
        dirty=True,
    ),
)

# --- marts ----------------------------------------------------------------------

_RATES = [*marts.COVERAGE_RATES, *marts.DQ_RATES]
_SEGMENT_KEY = ["as_of_month", "segment_name", "segment_value"]
_MONTHLY_SQL = f"select {listed(['as_of_month', *both_units(CORE + EXCLUDED), *_RATES])} from monthly"
_SEGMENT_SQL = f"select {listed([*_SEGMENT_KEY, *both_units(CORE), *marts.DQ_RATES])} from segments"
_FLOW_COLUMNS = [
    "from_month", "to_month", "segment_name", "segment_value", "from_state", "to_state",
    "transition_loan_count", "transition_from_upb", "observable_from_state_loan_count",
    "observable_from_state_upb", *marts.TRANSITION_RATES,
]
_FLOW_SQL = f"select {listed(_FLOW_COLUMNS)} from transition_mart"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.next_month_pairs_ordered(panel.fact(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.portfolio_monthly(panel.fact(spark, sf_dir))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.portfolio_by_segment(panel.fact(spark, sf_dir))


def _transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.transition_monthly(_pairs(spark, sf_dir))


_register("portfolio_monthly", _monthly, statement(_MONTHLY_SQL))
_register("portfolio_by_segment", _segments, statement(_SEGMENT_SQL))
_register(
    "portfolio_by_segment_prereduced",
    lambda s, d: marts.portfolio_by_segment_prereduced(panel.fact(s, d)),
    statement(_SEGMENT_SQL),
)
_register("transition_monthly", _transitions, statement(_FLOW_SQL))
_register(
    "transition_monthly_repeated_keys",
    lambda s, d: marts.transition_monthly(dirty.pairs(s, d)),
    statement(_FLOW_SQL, dirty=True),
)
_register(
    "portfolio_monthly_dirty",
    lambda s, d: marts.portfolio_monthly(dirty.fact(s, d)),
    statement(_MONTHLY_SQL.replace("from monthly", "from monthly_mart"), dirty=True),
)

# --- exports and suppression ------------------------------------------------------

_register(
    "export_monthly",
    lambda s, d: exports.export_monthly(_monthly(s, d)),
    statement(_MONTHLY_SQL),
)

_SEGMENT_EXPORT = [
    *_SEGMENT_KEY, "privacy_merged", "source_mart_row_count", *both_units(CORE), *_RATES,
    "segment_sort_order",
]
_FLOW_EXPORT = [
    "from_month", "to_month", "from_state", "to_state", "privacy_merged", "source_mart_row_count",
    "transition_loan_count", "transition_from_upb", "observable_from_state_loan_count",
    "observable_from_state_upb", *marts.TRANSITION_RATES, "from_state_sort_order",
    "to_state_sort_order",
]


def _segment_export(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    return suppression.suppress_segments(_segments(spark, sf_dir), k)


def _transition_export(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    return suppression.suppress_transitions(_transitions(spark, sf_dir), k)


for _threshold in (20, 60, 100, 400):
    _suffix = "" if _threshold == 20 else f"_k{_threshold}"
    _register(
        f"suppress_segments{_suffix}",
        partial(_segment_export, k=_threshold),
        statement(f"select {listed(_SEGMENT_EXPORT)} from segment_export", k=_threshold),
    )
    _register(
        f"suppress_transitions{_suffix}",
        partial(_transition_export, k=_threshold),
        statement(f"select {listed(_FLOW_EXPORT)} from transition_export", k=_threshold),
    )
_register(
    "suppress_segments_strict_k400",
    lambda s, d: suppression.suppress_segments(_segments(s, d), 400, strict=True),
    statement(
        f"select {listed(_SEGMENT_EXPORT)} from segment_export where on_book_loan_count >= 400",
        k=400,
    ),
)

# --- checks -----------------------------------------------------------------------

_NOT_EQUAL = " or ".join(f"s.{m} <> p.{m}" for m in both_units(CORE))


def _nested(unit: str, table: str) -> str:
    return (
        f"select 1 from {table} where dq30_{unit} > delinquency_eligible_{unit} "
        f"or dq60_{unit} > dq30_{unit} or dq90_{unit} > dq60_{unit}"
    )


_SEASONED = "zero_balance_code is null and current_actual_upb > 0 and loan_age >= 1"
_SPOT = {
    "on_book": "zero_balance_code is null and current_actual_upb > 0",
    "delinquency_eligible": f"{_SEASONED} and {TWO_DIGITS}",
    **{
        f"dq{30 * n}": f"{_SEASONED} and try_cast(delinquency_status_raw as int) >= {n}"
        for n in (1, 2, 3)
    },
}
_SPOT_MEASURES = ", ".join(
    f"count(*) filter ({p}) as {name}_loan_count, "
    f"coalesce(sum(current_actual_upb) filter ({p}), 0) as {name}_upb"
    for name, p in _SPOT.items()
)
_ROLLUP = ", ".join(f"sum({m}) as {m}" for m in both_units(CORE))
_MONTH_LIST = ", ".join(f"date '{m}'" for m in panel.SPOT_MONTHS)

# The documented zero-balance codes.
_KNOWN_CODES = "'01', '02', '03', '09', '15', '16', '96'"

# check -> SQL that yields one row per failure
_FAILING_ROWS = {
    "origination_loan_id_unique": (
        "select loan_id from orig group by loan_id having count(*) > 1 or loan_id is null"
    ),
    "performance_loan_month_unique": (
        "select loan_id, as_of_month from perf group by 1, 2 "
        "having count(*) > 1 or loan_id is null or as_of_month is null"
    ),
    "origination_performance_coverage": (
        "select loan_id from orig where loan_id not in (select loan_id from perf) union all "
        "select distinct loan_id from perf where loan_id not in (select loan_id from orig)"
    ),
    "origination_risk_fields_valid": (
        "select 1 from orig where classic_fico < 300 or classic_fico > 850 "
        "or original_cltv < 1 or original_cltv > 998 or original_dti < 0 or original_dti > 65 "
        "or original_upb is null or original_upb <= 0"
    ),
    "performance_months_valid": (
        "select 1 from perf where as_of_month is null or year(as_of_month) < source_year "
        f"or as_of_month > date '{panel.WINDOW_END}'"
    ),
    "delinquency_statuses_valid": (
        "select 1 from perf where delinquency_status_raw is null "
        "or not regexp_full_match(delinquency_status_raw, '[0-9][0-9]|RA|XX')"
    ),
    "zero_balance_codes_valid": (
        f"select 1 from perf where zero_balance_code not in ({_KNOWN_CODES})"
    ),
    "on_book_population_consistent": (
        "select 1 from perf where current_actual_upb is null or current_actual_upb < 0 "
        "or (zero_balance_code is null) <> (zero_balance_effective_month is null) "
        "or is_on_book_eom is distinct from (current_actual_upb > 0 and zero_balance_code is null)"
    ),
    "eligible_population_is_on_book": (
        "select 1 from fact where is_delinquency_eligible "
        "and (not is_on_book_eom or loan_age < 1 or not is_numeric_delinquency_status)"
    ),
    "delinquency_count_hierarchy": (
        f"{_nested('loan_count', 'monthly')} union all {_nested('loan_count', 'segments')}"
    ),
    "delinquency_upb_hierarchy": (
        f"{_nested('upb', 'monthly')} union all {_nested('upb', 'segments')}"
    ),
    "segment_dimensions_complete": (
        "select * from (select as_of_month, unnest(['origination_year', 'classic_fico', "
        "'original_cltv', 'original_dti']) from monthly) "
        "except select as_of_month, segment_name from segments"
    ),
    "segment_totals_reconcile": (
        f"select 1 from (select as_of_month, segment_name, {_ROLLUP} from segments group by 1, 2) s "
        f"join monthly p using (as_of_month) where {_NOT_EQUAL}"
    ),
    "monthly_metric_spot_checks": (
        f"select 1 from (select as_of_month, {_SPOT_MEASURES} from perf "
        f"where as_of_month in ({_MONTH_LIST}) group by 1) s "
        f"join monthly p using (as_of_month) where {_NOT_EQUAL}"
    ),
    "transition_pairs_are_adjacent_months": (
        "select 1 from pairs where to_month <> from_month + interval '1' month"
    ),
    "transition_sources_are_on_book": (
        "select 1 from pairs where from_upb <= 0 or starts_with(from_state, 'TERMINATED:')"
    ),
    "transition_cohort_totals_reconcile": (
        "select 1 from transitions group by from_month, segment_name, segment_value, from_state "
        "having sum(transition_loan_count) <> max(observable_from_state_loan_count) "
        "or sum(transition_from_upb) <> max(observable_from_state_upb)"
    ),
    "transition_rates_sum_to_one": (
        "select 1 from transitions group by from_month, segment_name, segment_value, from_state "
        "having abs(sum(transition_count_rate) - 1) > 1e-10 "
        "or abs(sum(transition_balance_rate) - 1) > 1e-10"
    ),
}
def _counts_differ(rows: str, expected: str) -> str:
    count = "select source_year, count(*) as n from {} group by 1"
    return (
        f"exists (select 1 from ({count.format(rows)}) a full join ({count.format(expected)}) b "
        "using (source_year) where a.n is distinct from b.n)"
    )


# Staged rows against the panel and the loans they come from.
_FAILING_ROWS = {
    "source_row_counts": (
        f"select 1 where {_counts_differ('orig', 'loans')} or {_counts_differ('perf', 'panel')}"
    ),
    **_FAILING_ROWS,
}


def _check_sql(name: str, rows: str) -> str:
    return (
        f"select '{name}' as check_name, count(*) as failed_row_count, count(*) = 0 as passed "
        f"from ({rows})"
    )


def _expectations(spark: SparkSession, sf_dir: str) -> quality.Expectations:
    """What the clean panel has, with counts taken from the source tables."""
    rows = panel.expected_rows(spark, sf_dir)
    return quality.Expectations(
        origination_rows=rows["origination"],
        performance_rows=rows["performance"],
        window_end=panel.WINDOW_END,
        spot_months=panel.SPOT_MONTHS,
    )


class _Layers:
    """The clean panel's tables, each derived when a check asks for it."""

    origination_pass = performance_pass = loan_months = flows = None

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._source = spark, sf_dir

    @cached_property
    def origination(self) -> DataFrame:
        return panel.staged_origination(*self._source)

    @cached_property
    def performance(self) -> DataFrame:
        return panel.staged_performance(*self._source)

    @cached_property
    def fact(self) -> DataFrame:
        return panel.fact(*self._source)

    @cached_property
    def pairs(self) -> DataFrame:
        return curated.next_month_pairs_ordered(self.fact)

    @cached_property
    def monthly(self) -> DataFrame:
        return marts.portfolio_monthly(self.fact)

    @cached_property
    def segments(self) -> DataFrame:
        return marts.portfolio_by_segment(self.fact)

    @cached_property
    def transitions(self) -> DataFrame:
        return marts.transition_monthly(self.pairs)


_NO_COUNTS = quality.Expectations({}, {}, panel.WINDOW_END, panel.SPOT_MONTHS)
_REPORT = ["check_name", "failed_row_count", "passed"]


def _check(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    layers = _Layers(spark, sf_dir)
    expect = _NO_COUNTS
    if name == "source_row_counts":
        expect = _expectations(spark, sf_dir)
    return quality.validation_results(layers, expect, [name]).select(*_REPORT)


for _name, _rows in _FAILING_ROWS.items():
    _register(
        f"check_{_name}", partial(_check, name=_name), statement(_check_sql(_name, _rows))
    )


def _checks_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Clean row counts are expected, so the removed and doubled rows show up.
    clean = _expectations(spark, sf_dir)
    return quality.validation_results(dirty.layers(spark, sf_dir), clean).select(*_REPORT)


_register(
    "checks_dirty",
    _checks_dirty,
    statement(
        " union all ".join(_check_sql(name, rows) for name, rows in _FAILING_ROWS.items()),
        dirty=True,
    ),
)
_register(
    "vintage_matches_file_year",
    lambda s, d: quality.row_count(
        quality.vintage_disagreements(panel.staged_origination(s, d)), "vintage_matches_file_year"
    ),
    statement(
        "select 'vintage_matches_file_year' as check_name, count(*) as failed_row_count "
        "from orig where origination_year <> source_year"
    ),
)
_register(
    "population_identity_dirty",
    lambda s, d: quality.population_identity_failures(dirty.monthly(dirty.fact(s, d))).select(
        "as_of_month"
    ),
    statement(
        "select as_of_month from monthly where on_book_loan_count <> delinquency_eligible_loan_count"
        " + excluded_loan_age_zero_loan_count + excluded_invalid_loan_age_loan_count"
        " + excluded_non_numeric_status_loan_count or on_book_upb <> delinquency_eligible_upb"
        " + excluded_loan_age_zero_upb + excluded_invalid_loan_age_upb"
        " + excluded_non_numeric_status_upb"
        " or excluded_pre_due_loan_count > excluded_loan_age_zero_loan_count",
        dirty=True,
    ),
)

# --- export checks ------------------------------------------------------------------

_K = 20
_EXPORT_CHECKS = {
    "portfolio row count": (
        "select unnest(range(abs((select count(*) from monthly_export) "
        "- (select count(*) from monthly))))"
    ),
    "segment key uniqueness": (
        "select 1 from segment_shown group by as_of_month, segment_name, segment_value "
        "having count(*) > 1"
    ),
    "segment totals": (
        f"select 1 from (select as_of_month, segment_name, {_ROLLUP} from segment_shown "
        f"group by 1, 2) s join monthly_export p using (as_of_month) where {_NOT_EQUAL}"
    ),
    "transition key uniqueness": (
        "select 1 from flow_shown group by from_month, from_state, to_state having count(*) > 1"
    ),
    "transition cohort totals": (
        "select * from (select from_month, from_state, sum(transition_loan_count) as n, "
        "sum(transition_from_upb) as u from transitions where segment_name = 'all' "
        f"group by 1, 2 having n >= {_K}) e full join (select from_month, from_state, "
        "sum(transition_loan_count) as n, sum(transition_from_upb) as u from flow_shown "
        "group by 1, 2) x using (from_month, from_state) "
        "where e.n is distinct from x.n or e.u is distinct from x.u"
    ),
}
_SHOWN = {
    "monthly_export": "select * from monthly",
    "segment_shown": "select * from segment_export",
    "flow_shown": "select * from transition_export",
}
_SHOWN_DIRTY = {
    "monthly_export": "select * from monthly where as_of_month <> date '2020-01-01'",
    "segment_shown": (
        "select t.* from segment_export t, range(2) copies(c) where c = 0 "
        "or (as_of_month = date '2021-01-01' and segment_name = 'classic_fico')"
    ),
    "flow_shown": (
        "select t.* from transition_export t, range(2) copies(c) "
        "where (c = 0 or from_month = date '2022-06-01') and from_month <> date '2022-05-01'"
    ),
}


def _export_report(spark: SparkSession, sf_dir: str, tampered: bool = False) -> DataFrame:
    # Several checks read each mart, which is small; the panel behind it is derived once for each.
    folder = storage.scratch_dir(spark, "marts")
    monthly = storage.written(_monthly(spark, sf_dir), f"{folder}/monthly")
    flows = storage.written(_transitions(spark, sf_dir), f"{folder}/transitions")
    monthly_export = exports.export_monthly(monthly)
    segment_export = storage.written(_segment_export(spark, sf_dir, _K), f"{folder}/segments")
    flow_export = suppression.suppress_transitions(flows, _K)
    if tampered:
        def is_month(column: str, month: str):
            return F.col(column) == F.lit(month).cast("date")

        monthly_export = monthly_export.filter(~is_month("as_of_month", "2020-01-01")).withColumn(
            "first_loan_id", F.lit("x")
        )
        segment_export = segment_export.unionByName(
            segment_export.filter(
                is_month("as_of_month", "2021-01-01") & (F.col("segment_name") == "classic_fico")
            )
        )
        kept = flow_export.filter(~is_month("from_month", "2022-05-01"))
        flow_export = kept.unionByName(kept.filter(is_month("from_month", "2022-06-01")))
    return export_results(
        monthly_export, segment_export, flow_export, monthly, flows, _K
    ).select(*_REPORT)


def _export_sql(shown: dict[str, str], identifiers: int) -> str:
    parts = [_check_sql(name, rows) for name, rows in _EXPORT_CHECKS.items()]
    parts.append(
        f"select 'loan identifier columns' as check_name, cast({identifiers} as bigint) "
        f"as failed_row_count, {str(identifiers == 0).lower()} as passed"
    )
    return statement(" union all ".join(parts), k=_K, extra=shown)


_register("checks_export", _export_report, _export_sql(_SHOWN, 0))
_register("checks_export_dirty", partial(_export_report, tampered=True), _export_sql(_SHOWN_DIRTY, 1))


def _dashboard_inputs(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    monthly = exports.export_monthly(_monthly(spark, sf_dir))
    segments, transitions = _segment_export(spark, sf_dir), _transition_export(spark, sf_dir)
    if damaged:
        again = F.col("as_of_month") < F.lit("2019-07-01").cast("date")
        monthly = monthly.unionByName(monthly.filter(again)).withColumn("loan_id", F.lit("x"))
        segments = segments.filter("false")
        transitions = transitions.unionByName(transitions).withColumn("x_loan_id", F.lit("x"))
    return dashboard_input_problems(
        monthly,
        segments,
        transitions,
        month_count=panel.MONTH_COUNT,
        first_month=panel.FIRST_MONTH,
        last_month="2025-12-01",
    ).select(*_REPORT)


_INPUTS = {
    "monthly_in": "select *, null as no_column from monthly",
    "segments_in": "select *, null as no_column from segment_export",
    "transitions_in": "select *, null as no_column from transition_export",
}
_INPUTS_DAMAGED = {
    "monthly_in": (
        "select m.*, 'x' as loan_id from monthly m, range(2) copies(c) "
        "where c = 0 or as_of_month < date '2019-07-01'"
    ),
    "segments_in": "select *, null as no_column from segment_export where false",
    "transitions_in": "select t.*, 'x' as x_loan_id from transition_export t, range(2) copies(c)",
}


def _inputs_sql(inputs: dict[str, str]) -> str:
    tables = {
        "monthly": ("monthly_in", "as_of_month"),
        "segments": ("segments_in", "as_of_month, segment_name, segment_value"),
        "transitions": ("transitions_in", "from_month, from_state, to_state"),
    }
    parts = []
    for name, (table, key) in tables.items():
        parts.append(
            f"select '{name} not empty' as check_name, "
            f"cast(count(*) = 0 as bigint) as failed_row_count, count(*) > 0 as passed from {table}"
        )
        parts.append(
            _check_sql(
                f"{name} key uniqueness", f"select 1 from {table} group by {key} having count(*) > 1"
            )
        )
        # Identifiers are found in the columns themselves.
        disclosed = int("loan_id" in inputs[table])
        parts.append(
            f"select '{name} identifier columns', cast({disclosed} as bigint), {disclosed} = 0"
        )
    window = {
        "month count": f"count(*) = {panel.MONTH_COUNT}",
        "first month": f"min(as_of_month) = date '{panel.FIRST_MONTH}'",
        "last month": "max(as_of_month) = date '2025-12-01'",
    }
    parts += [
        f"select '{name}', cast(not ({met}) as bigint), {met} from monthly_in"
        for name, met in window.items()
    ]
    return statement(" union all ".join(parts), extra=inputs)


_register("check_dashboard_inputs", _dashboard_inputs, _inputs_sql(_INPUTS))
_register(
    "check_dashboard_inputs_damaged",
    partial(_dashboard_inputs, damaged=True),
    _inputs_sql(_INPUTS_DAMAGED),
)

# --- reports --------------------------------------------------------------------------

_COUNT_TABLES = {
    "curated.fact_loan_month": "fact",
    "mart.delinquency_transition_monthly": "transitions",
    "mart.portfolio_monthly": "monthly",
    "mart.portfolio_monthly_by_segment": "segments",
    "staging.monthly_performance": "performance",
    "staging.origination": "origination",
}


def _table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _Layers(spark, sf_dir)
    return build_plan.table_row_counts(
        {name: getattr(layers, attribute) for name, attribute in _COUNT_TABLES.items()}
    )


_COUNTS_SQL = statement(
    " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from "
        + {"performance": "perf", "origination": "orig"}.get(block, block)
        for name, block in _COUNT_TABLES.items()
    )
)
_register("table_row_counts", _table_row_counts, _COUNTS_SQL)


def _validation_summary_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    expect = _expectations(spark, sf_dir)
    return quality.validation_summary(quality.validation_results(dirty.layers(spark, sf_dir), expect))


_register(
    "validation_summary_dirty",
    _validation_summary_dirty,
    statement(
        "select count(*) as checks, count(*) filter (passed) as passed from ("
        + " union all ".join(
            f"select count(*) = 0 as passed from ({rows})" for rows in _FAILING_ROWS.values()
        )
        + ")",
        dirty=True,
    ),
)

# --- panels ---------------------------------------------------------------------------

_register("panel_trend", lambda s, d: panels.trend(_monthly(s, d)), statement(
    f"select {listed(['as_of_month', *both_units(CORE[:2]), *_RATES])} from monthly"
))
_register(
    "panel_defaults",
    lambda s, d: panels.default_selection(_monthly(s, d), _transition_export(s, d)),
    statement(
        "select max(as_of_month) as snapshot_month, any_value(f) as from_month, "
        "cast(any_value(f) + interval '1' month as date) as to_month, "
        "strftime(max(as_of_month), '%Y-%m') as snapshot_label "
        "from monthly, (select max(from_month) as f from transition_export) t"
    ),
)


def _snapshot_sql(month: str) -> str:
    pieces = ", ".join(f"coalesce(sum({m}), 0) as {m}" for m in both_units(CORE[:2]))
    names = both_units(CORE[:2])
    amounts = ", ".join(
        f"cast({m} as {'double' if m.endswith('upb') else 'bigint'}) as {m}" for m in names
    )
    return statement(
        f"select {amounts}, "
        "delinquency_eligible_loan_count / nullif(on_book_loan_count, 0)::double "
        "as numeric_status_coverage_count_rate, "
        "delinquency_eligible_upb::double / nullif(on_book_upb, 0)::double "
        "as numeric_status_coverage_balance_rate "
        f"from (select {pieces} from monthly where as_of_month = date '{month}')"
    )


for _label, _month in (("", SNAPSHOT), ("_absent_month", ABSENT_MONTH)):
    _register(
        f"panel_snapshot{_label}",
        lambda s, d, month=_month: panels.snapshot(_monthly(s, d), month),
        _snapshot_sql(_month),
    )

# dimension -> labels shown
_SHOWN_LABELS = {
    "origination_year": ["2019", "2020"],
    **{
        name: [*labels, "Other / low volume"]
        for name, labels in zip(["classic_fico", "original_cltv", "original_dti"], BAND_PLACES)
    },
}


def _labels_sql(labels: list[str]) -> str:
    return ", ".join(f"({place}, '{label}')" for place, label in enumerate(labels, start=1))


def _segment_panel_sql(dimension: str, month: str) -> str:
    columns = both_units(CORE)
    zeroed = ", ".join(
        f"cast(coalesce({m}, 0) as {'decimal(38,2)' if m.endswith('upb') else 'bigint'}) as {m}"
        for m in columns
    )
    rates = ", ".join(
        f"cast({top} as double) / cast(nullif({bottom}, 0) as double) as {name}"
        for name, (top, bottom) in (marts.COVERAGE_RATES | marts.DQ_RATES).items()
    )
    return statement(
        f"select position, segment_value, {listed(columns[:4])}, {rates}, "
        "if(segment_value = 'Other / low volume', 'Merged to minimum 20', '') as low_volume_note "
        f"from (select position, label as segment_value, {zeroed} "
        f"from (values {_labels_sql(_SHOWN_LABELS[dimension])}) d(position, label) "
        "left join (select * from segment_export "
        f"where as_of_month = date '{month}' and segment_name = '{dimension}') "
        "on segment_value = label)"
    )


for _dimension in _SHOWN_LABELS:
    _register(
        f"panel_segment_{_dimension}",
        lambda s, d, dim=_dimension: panels.segment_panel(_segment_export(s, d), SNAPSHOT, dim),
        _segment_panel_sql(_dimension, SNAPSHOT),
    )


def _focus_sql(month: str, state: str) -> str:
    return statement(
        "select cast(coalesce(sum(transition_loan_count), 0) as bigint) as transition_loan_count, "
        "cast(coalesce(sum(transition_from_upb), 0) as double) as transition_from_upb, "
        "count(*) as visible_destinations from transition_export "
        f"where from_month = date '{month}' and from_state = '{state}'"
    )


for _state in ("CURRENT", "REO_ACQUISITION"):
    _register(
        f"panel_focus_{_state.lower()}",
        lambda s, d, state=_state: panels.focus_state(_transition_export(s, d), SNAPSHOT, state),
        _focus_sql(SNAPSHOT, _state),
    )


def _matrix_sql(weight: str) -> str:
    cells = ", ".join(
        f"coalesce(sum({weight}) filter (to_state = '{state}'), 0)::double "
        f'/ sum({weight})::double as "{state}"'
        for state in DESTINATION_STATES
    )
    states = ", ".join(f'm."{state}"' for state in DESTINATION_STATES)
    return statement(
        f"select position, label as from_state, {states} "
        f"from (values {_labels_sql(OPEN_STATES)}) d(position, label) "
        f"left join (select from_state, {cells} from transition_export "
        f"where from_month = date '{SNAPSHOT}' group by 1) m on m.from_state = label"
    )


for _label, _weight in (("count", "transition_loan_count"), ("upb", "transition_from_upb")):
    _register(
        f"panel_matrix_{_label}",
        lambda s, d, w=_weight: panels.migration_matrix(_transition_export(s, d), SNAPSHOT, w),
        _matrix_sql(_weight),
    )
_register(
    "panel_cohorts",
    lambda s, d: panels.cohorts(_transition_export(s, d), SNAPSHOT),
    statement(
        "select position, label as from_state, "
        "cast(coalesce(n, 0) as bigint) as transition_loan_count, "
        "cast(coalesce(u, 0) as double) as transition_from_upb "
        f"from (values {_labels_sql(OPEN_STATES)}) d(position, label) left join ("
        "select from_state, sum(transition_loan_count) as n, sum(transition_from_upb) as u "
        f"from transition_export where from_month = date '{SNAPSHOT}' group by 1) "
        "on from_state = label"
    ),
)


def _mix_sql(state: str) -> str:
    flows = (
        f"(select * from transition_export where from_month = date '{SNAPSHOT}' "
        f"and from_state = '{state}')"
    )
    return statement(
        "select position, label as to_state, "
        f"coalesce(n, 0)::double / (select sum(transition_loan_count) from {flows})::double "
        "as count_rate, "
        f"coalesce(u, 0)::double / (select sum(transition_from_upb) from {flows})::double "
        "as balance_rate "
        f"from (values {_labels_sql(DESTINATION_STATES)}) d(position, label) left join ("
        "select to_state, sum(transition_loan_count) as n, sum(transition_from_upb) as u "
        f"from {flows} group by 1) on to_state = label"
    )


for _label, _state in (("", "CURRENT"), ("_absent_cohort", "REO_ACQUISITION")):
    _register(
        f"panel_destination_mix{_label}",
        lambda s, d, state=_state: panels.destination_mix(_transition_export(s, d), SNAPSHOT, state),
        _mix_sql(_state),
    )

# --- files ----------------------------------------------------------------------------


def _stored_by_year(raw_dir: str, dataset: str, lines: DataFrame) -> DataFrame:
    """Store lines, write them as one raw file for each year and return what was stored."""
    part = delimited.DATASETS[dataset][0]
    stored = storage.written(lines.select("source_year", "value"), f"{raw_dir}/lines/{dataset}")
    for year in VINTAGES:
        of_year = stored.filter(F.col("source_year") == year).select("value")
        of_year.write.text(f"{raw_dir}/sample_{year}/sample_{part}_{year}.txt")
    return stored


def _raw_files(
    spark: SparkSession, sf_dir: str, spoil: Callable[[DataFrame], DataFrame] | None = None
) -> str:
    """Write the panel as raw files into a fresh folder and return it."""
    raw_dir = storage.scratch_dir(spark, "raw")
    performance = delimited.as_lines(panel.raw_performance(spark, sf_dir), PERFORMANCE_FIELDS)
    if spoil is not None:
        performance = spoil(performance)
    # Lines are put together once; a column for each field would be read once for each year.
    stored = _stored_by_year(raw_dir, "performance", performance)
    if spoil is None:
        # The lines begin with the loan, so the panel is not derived again to see which occur.
        observed = stored.select(F.substring_index("value", "|", 1).alias("loan_id")).distinct()
        origination = panel.raw_origination(spark, sf_dir, only_observed=False)
        origination = origination.join(observed, "loan_id", "left_semi")
    else:
        origination = panel.raw_origination(spark, sf_dir)
    _stored_by_year(raw_dir, "origination", delimited.as_lines(origination, ORIGINATION_FIELDS))
    return raw_dir


def _spoil(lines: DataFrame) -> DataFrame:
    """Plant damage in raw performance lines, by ``k`` and ``mp``."""
    value, mp = F.col("value"), F.col("mp")
    damaged = (
        F.when(mp % 211 == 1, F.concat(value, F.lit("|extra")))
        .when(mp % 223 == 2, F.lit("short|row"))
        .when(mp % 227 == 3, F.regexp_replace(value, r"^([^|]*)\|[0-9]{6}\|", "$1|201913|"))
        .when(mp % 229 == 4, F.regexp_replace(value, "Servicer ", "Sérvicer "))
        .when(mp % 233 == 5, F.regexp_replace(value, "Servicer ([0-9])", '"Pipe|name $1"'))
        .when(mp % 239 == 6, F.regexp_replace(value, r"^([^|]*\|[^|]*\|[^|]*)\|[^|]*\|", "$1|Q7|"))
        .otherwise(value)
    )
    return lines.filter(F.col("k") % 60 != 11).withColumn("value", damaged)


def _profile(spark: SparkSession, sf_dir: str, spoil=None) -> DataFrame:
    return profile_files(spark, _raw_files(spark, sf_dir, spoil))


_PROFILE_BLOCKS = {
    "orig_numbers": """
        select o.source_year, unnest([classic_fico, original_cltv, original_dti, original_upb,
            original_ltv, original_interest_rate, original_loan_term, vantage_score_4]) as n
        from orig_text o""",
    "orig_missing": " union all ".join(
        "select 'origination' as dataset, source_year, 'missing_important_fields' as metric, "
        f"'{name}' as item, count(*) filter ({name} = '') as value from orig_text group by 2"
        for name in raw_profile.ORIGINATION_REQUIRED
    ),
    "orig_sentinels": " union all ".join(
        "select 'origination' as dataset, source_year, 'official_sentinel_counts' as metric, "
        f"'{name}={code}' as item, count(*) filter ({name} = '{code}') as value "
        "from orig_text group by 2"
        for name, code in raw_profile.ORIGINATION_SENTINELS.items()
    ),
    "profile_clean": """
        select 'origination' as dataset, source_year, 'row_count' as metric,
               cast(null as varchar) as item, count(*) as value from orig_text group by 2
        union all select 'performance', source_year, 'row_count', null, count(*)
            from panel group by 2
        union all select 'origination', source_year, unnest(['rows_with_wrong_field_count',
            'rows_with_non_ascii_text', 'invalid_required_dates', 'duplicate_loan_ids']), null, 0
            from (select distinct source_year from orig_text)
        union all select 'performance', source_year, unnest(['rows_with_wrong_field_count',
            'rows_with_non_ascii_text', 'invalid_periods']), null, 0
            from (select distinct source_year from panel)
        union all select 'origination', source_year, 'nonnumeric_values_in_numeric_fields', null,
            count(*) filter (try_cast(n as double) is null) from orig_numbers group by 2
        union all select 'performance', source_year, 'nonnumeric_upb_or_loan_age', null,
            count(*) filter (loan_age is null) from panel group by 2
        union all select 'performance', source_year, 'missing_important_fields', 'loan_age',
            count(*) filter (loan_age is null) from panel group by 2
        union all select 'performance', source_year, unnest(['invalid_delinquency_statuses',
            'invalid_zero_balance_codes', 'performance_loans_without_origination',
            'originations_without_performance']), null, 0
            from (select distinct source_year from panel)
        union all select 'performance', source_year, 'missing_important_fields', unnest(['loan_id',
            'period', 'current_actual_upb', 'current_loan_delinquency_status']), 0
            from (select distinct source_year from panel)
        union all select * from orig_missing
        union all select 'performance', source_year, 'min_performance_month', null,
            min(year(as_of_month) * 100 + month(as_of_month)) from panel group by 2
        union all select 'performance', source_year, 'max_performance_month', null,
            max(year(as_of_month) * 100 + month(as_of_month)) from panel group by 2
        union all select * from orig_sentinels
        union all select 'origination', null, 'cross_vintage_loan_id_overlap', null, count(*)
            from (select loan_id from orig_text group by 1 having count(distinct source_year) > 1)""",
    # Damage planted in the raw lines; the first matching kind applies.
    "spoiled": """
        select *, case when mp % 211 = 1 or mp % 223 = 2 then 'fields'
                       when mp % 227 = 3 then 'period' when mp % 229 = 4 then 'text'
                       when mp % 233 = 5 then 'quoted' when mp % 239 = 6 then 'status' end as damage
        from panel where k % 60 <> 11""",
}

_FAILURE_LABEL = "source_year || ' ' || dataset"
_PROFILE_COLUMNS = "dataset, source_year, metric, item, value"
for _dataset in ("origination", "performance"):
    _register(
        f"raw_profile_{_dataset}",
        lambda s, d, dataset=_dataset: _profile(s, d).filter(F.col("dataset") == dataset),
        statement(
            f"select {_PROFILE_COLUMNS} from profile_clean where dataset = '{_dataset}'",
            extra=_PROFILE_BLOCKS,
        ),
    )


def _raw_failures_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = panel.expected_rows(spark, sf_dir)
    expected = {
        (dataset, year): n for dataset, years in counted.items() for year, n in years.items()
    }
    return raw_profile.raw_failures(_profile(spark, sf_dir, _spoil), expected)


_register(
    "raw_failures_damaged",
    _raw_failures_dirty,
    statement(
        f"""select dataset, source_year, metric, value, message from (
            select 'performance' as dataset, p.source_year, 'row_count' as metric, s.n as value,
                   p.source_year || ' performance: expected ' || p.n || ' rows' as message
            from (select source_year, count(*) as n from panel group by 1) p
            join (select source_year, count(*) as n from spoiled group by 1) s
              on p.source_year = s.source_year
            where p.n <> s.n
            union all
            select *, {_FAILURE_LABEL} || ': ' || metric || '=' || value as message from (
                select dataset, source_year, metric, value from profile_clean
                where metric = 'nonnumeric_values_in_numeric_fields' and value > 0
                union all select 'performance' as dataset, source_year,
                    'rows_with_wrong_field_count' as metric, count(*) as value
                    from spoiled where damage = 'fields' group by 2
                union all select 'performance', source_year, 'invalid_periods', count(*)
                    from spoiled where damage = 'period' group by 2
                union all select 'performance', source_year, 'rows_with_non_ascii_text', count(*)
                    from spoiled where damage = 'text' group by 2
                union all select 'performance', source_year, 'invalid_delinquency_statuses', count(*)
                    from spoiled where damage = 'status' group by 2
                union all select 'performance', source_year, 'nonnumeric_upb_or_loan_age', count(*)
                    from spoiled where coalesce(damage, '') <> 'fields' and loan_age is null group by 2
                union all select 'performance', source_year, 'originations_without_performance',
                    count(*) from loans where loan_id not in (
                        select loan_id from spoiled where coalesce(damage, '') <> 'fields') group by 2))""",
        extra=_PROFILE_BLOCKS,
    ),
)


def _file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_dir = _raw_files(spark, sf_dir)
    staged = stage_performance(delimited.scan_performance(spark, raw_dir))
    return staged.select(
        *(c for c in _FACT_COLUMNS if c in staged.columns),
        "is_valid_loan_age",
        F.element_at(F.split("source_file", "/"), -2).alias("file_name"),
    )


# --- files in which every rule finds something ----------------------------------------

# What is wrong with an origination line, by loan; the first that applies.
_ORIGINATION_DAMAGE = """case
    when k % 31 = 1 then 'fields' when k % 37 = 2 then 'text' when k % 41 = 3 then 'date'
    when k % 43 = 4 then 'number' when k % 47 = 5 then 'twice' when k % 53 = 6 then 'other year'
    when k % 59 = 7 then 'dropped' else '' end"""
# And with a performance line.
_PERFORMANCE_DAMAGE = """case
    when mp % 211 = 1 then 'fields' when mp % 227 = 3 then 'period' when mp % 229 = 4 then 'text'
    when mp % 239 = 6 then 'status' when mp % 241 = 7 then 'code' when mp % 251 = 8 then 'number'
    else '' end"""


def _with_field(value: Column, number: int, new: str) -> Column:
    """A line with one of its fields replaced; fields count from 1."""
    return F.regexp_replace(value, rf"^((?:[^|]*\|){{{number - 1}}})[^|]*", f"$1{new}")


def _fully_damaged(spark: SparkSession, sf_dir: str) -> str:
    raw_dir = storage.scratch_dir(spark, "raw")
    damage, value = F.col("damage"), F.col("value")
    other = F.when(damage == "other year", 4039 - F.col("source_year").cast("int"))
    own = F.col("source_year").cast("int")
    originations = delimited.as_lines(
        panel.raw_origination(spark, sf_dir).withColumn("damage", F.expr(_ORIGINATION_DAMAGE)),
        ORIGINATION_FIELDS,
    ).select(
        F.explode(
            F.when(damage == "twice", F.array(own, own))
            .when(damage == "other year", F.array(own, other))
            .when(damage == "dropped", F.array().cast("array<int>"))
            .otherwise(F.array(own))
        ).alias("year"),
        F.when(damage == "fields", F.concat(value, F.lit("|extra")))
        .when(damage == "text", F.regexp_replace(value, "Seller ", "Séller "))
        .when(damage == "date", _with_field(value, 2, "201913"))
        .when(damage == "number", _with_field(value, 11, "5F"))
        .otherwise(value)
        .alias("value"),
    )
    performances = delimited.as_lines(
        panel.raw_performance(spark, sf_dir).withColumn("damage", F.expr(_PERFORMANCE_DAMAGE)),
        PERFORMANCE_FIELDS,
    ).select(
        own.alias("year"),
        F.when(damage == "fields", F.lit("short|row"))
        .when(damage == "period", _with_field(value, 2, "201913"))
        .when(damage == "text", F.regexp_replace(value, "Servicer ", "Sérvicer "))
        .when(damage == "status", _with_field(value, 4, "Q7"))
        .when(damage == "code", _with_field(value, 9, "77"))
        .when(damage == "number", _with_field(value, 3, "0x1p3"))
        .otherwise(value)
        .alias("value"),
    )
    for dataset, lines in (("origination", originations), ("performance", performances)):
        stored = storage.written(lines, f"{raw_dir}/lines/{dataset}")
        for year in VINTAGES:
            of_year = stored.filter(F.col("year") == year).select("value")
            of_year.write.text(delimited.expected_file(raw_dir, dataset, year))
    return raw_dir


_DAMAGED_BLOCKS = {
    "damaged_orig": f"""
        select *, damage <> 'fields' as usable from (
            select o.*, {_ORIGINATION_DAMAGE} as damage,
                   unnest(case when k % 53 = 6 then [source_year, 4039 - source_year]
                               else [source_year, source_year] end) as year,
                   unnest([1, 2]) as copy
            from orig_text o)
        where damage <> 'dropped' and (copy = 1 or damage in ('twice', 'other year'))
          and (damage = 'other year' or year = source_year)""",
    "damaged_perf": f"""
        select *, damage <> 'fields' as usable from (
            select p.*, {_PERFORMANCE_DAMAGE} as damage from panel p)""",
    "orig_ids": "select distinct year, loan_id from damaged_orig where usable",
    "perf_ids": "select distinct source_year as year, loan_id from damaged_perf where usable",
}
_ORIGINATION_NUMBER_TEXTS = ", ".join(raw_profile.ORIGINATION_NUMBERS)
_DAMAGED_RULES = {
    "rows_with_wrong_field_count": (
        "select (select count(*) from damaged_orig where damage = 'fields') "
        "+ (select count(*) from damaged_perf where damage = 'fields')"
    ),
    "rows_with_non_ascii_text": (
        "select (select count(*) from damaged_orig where damage = 'text') "
        "+ (select count(*) from damaged_perf where damage = 'text')"
    ),
    "duplicate_loan_ids": (
        "select sum(n - 1) from (select count(*) as n from damaged_orig where usable "
        "group by year, loan_id)"
    ),
    "invalid_required_dates": "select count(*) from damaged_orig where damage = 'date'",
    "nonnumeric_values_in_numeric_fields": (
        "select count(*) filter (n = '') + (select count(*) from damaged_orig where damage = 'number') "
        f"from (select unnest([{_ORIGINATION_NUMBER_TEXTS}]) as n from damaged_orig where usable)"
    ),
    "invalid_periods": "select count(*) from damaged_perf where damage = 'period'",
    "nonnumeric_upb_or_loan_age": (
        "select count(*) filter (loan_age is null) + count(*) filter (damage = 'number') "
        "from damaged_perf where usable"
    ),
    "invalid_delinquency_statuses": "select count(*) from damaged_perf where damage = 'status'",
    "invalid_zero_balance_codes": "select count(*) from damaged_perf where damage = 'code'",
    "performance_loans_without_origination": (
        "select count(*) from (select * from perf_ids except select * from orig_ids)"
    ),
    "originations_without_performance": (
        "select count(*) from (select * from orig_ids except select * from perf_ids)"
    ),
    "cross_vintage_loan_id_overlap": (
        "select count(*) from (select loan_id from orig_ids group by 1 having count(*) > 1)"
    ),
}
_register(
    "raw_rules_damaged",
    lambda s, d: profile_files(s, _fully_damaged(s, d))
    .filter(F.col("metric").isin(raw_profile.MUST_BE_ZERO))
    .groupBy("metric")
    .agg(F.sum("value").alias("value")),
    statement(
        " union all ".join(
            f"select '{name}' as metric, cast(({rows}) as bigint) as value"
            for name, rows in _DAMAGED_RULES.items()
        ),
        extra=_DAMAGED_BLOCKS,
    ),
)


def _origination_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the origination files and the name of the file that each came from."""
    rows = delimited.scan_origination(spark, _raw_files(spark, sf_dir))
    # Spark writes a file as a folder of parts; the folder has the file's name.
    file_name = F.element_at(F.split("source_file", "/"), -2)
    return rows.select("source_year", file_name.alias("file_name"), *ORIGINATION_FIELDS)


_register(
    "raw_file_roundtrip_origination",
    _origination_roundtrip,
    statement(
        "select source_year, 'sample_orig_' || source_year || '.txt' as file_name, "
        + ", ".join(
            f"nullif({name}, '') as {name}" if name in panel.ORIGINATION_TEXT else f"null as {name}"
            for name in ORIGINATION_FIELDS
        )
        + " from orig_text"
    ),
)

def _with_line_feeds(lines: DataFrame) -> DataFrame:
    """Some servicers have a name of three lines, with a quote and a pipe in it."""
    several = F.regexp_replace("value", "Servicer ([0-9])", '"Servicer\n\n""$1""|$1"')
    return lines.withColumn("value", F.when(F.col("mp") % 17 == 3, several).otherwise(F.col("value")))


def _line_feeds_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delimited.scan_performance(spark, _raw_files(spark, sf_dir, _with_line_feeds))
    return rows.select("source_year", "loan_id", "period", "servicer_name", "ddlpi")


_register(
    "raw_records_with_line_feeds",
    _line_feeds_roundtrip,
    statement(
        "select source_year, loan_id, strftime(as_of_month, '%Y%m') as period, "
        "case when mp % 17 = 3 then 'Servicer' || chr(10) || chr(10) || '\"' || (k % 10) || '\"|' || (k % 10) "
        "else 'Servicer ' || (k % 10) end as servicer_name, strftime(as_of_month, '%Y%m') as ddlpi from perf"
    ),
)
_register(
    "raw_row_counts_with_line_feeds",
    lambda s, d: profile_files(s, _raw_files(s, d, _with_line_feeds)).filter(
        "dataset = 'performance' AND metric IN ('row_count', 'rows_with_wrong_field_count')"
    ).select("source_year", "metric", "value"),
    statement(
        "select source_year, 'row_count' as metric, count(*) as value from perf group by 1 "
        "union all select distinct source_year, 'rows_with_wrong_field_count', 0 from perf"
    ),
)

_register(
    "loan_month_summary",
    lambda s, d: loan_months.month_summary(
        loan_months.loan_months(panel.fact(s, d), loan_months.word_count(2019, panel.WINDOW_END))
    ),
    statement(
        "select loan_id, count(*) as row_count, count(distinct as_of_month) as months, "
        "count(*) filter (is_on_book_eom and next = as_of_month + interval 1 month) as adjacent_pairs "
        "from (select *, lead(as_of_month) over (partition by loan_id order by as_of_month) as next from fact) "
        "group by loan_id"
    ),
)
_register(
    "repeated_loan_months_dirty",
    lambda s, d: _repeated_dirty(s, d),
    statement(
        "select loan_id, as_of_month, count(*) as n from perf group by 1, 2 "
        "having count(*) > 1 or loan_id is null or as_of_month is null",
        dirty=True,
    ),
)


def _repeated_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dirty.performance(spark, sf_dir)
    reduced = loan_months.loan_months(rows, 1)  # months after the first 64 are told apart row by row
    stored = storage.written(reduced, f"{storage.scratch_dir(spark, 'months')}/reduced")
    return loan_months.repeated_loan_months(rows, stored)


def _with_many_codes(lines: DataFrame) -> DataFrame:
    """A status of its own in many lines, as a shifted column has it, and one common bad code."""
    mp, value = F.col("mp"), F.col("value")
    own = F.concat(F.lit("$1S"), "loan_id", F.lit("-"), mp)
    several = F.regexp_replace(value, F.lit(r"^((?:[^|]*\|){3})[^|]*"), own)
    common = _with_field(value, 9, "77")
    return lines.withColumn("value", F.when(mp % 3 == 1, several).when(mp % 7 == 2, common).otherwise(value))


def _bounded_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = F.col("metric").isin("invalid_delinquency_statuses", "invalid_zero_balance_codes")
    rows = profile_files(spark, _raw_files(spark, sf_dir, _with_many_codes)).filter(coded)
    return rows.groupBy("source_year", "metric").agg(
        F.sum("value").alias("value"),
        F.coalesce(F.sum(F.when(F.col("item") == "77", F.col("value"))), F.lit(0)).alias("of_77"),
        (F.count("*") <= raw_profile.SHOWN_CODES + 1).alias("bounded"),
    )


_register(
    "raw_codes_bounded",
    _bounded_codes,
    statement(
        "select source_year, 'invalid_delinquency_statuses' as metric, count(*) filter (mp % 3 = 1) as value, "
        "0 as of_77, true as bounded from perf group by 1 union all "
        "select source_year, 'invalid_zero_balance_codes', count(*) filter (mp % 3 <> 1 and mp % 7 = 2), "
        "count(*) filter (mp % 3 <> 1 and mp % 7 = 2), true from perf group by 1"
    ),
)

def _stored_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month out of the stored panel, which is clustered by loan and ordered by month."""
    fact = _built(spark, sf_dir).store.read(build_plan.PANEL)
    month = fact.filter(F.col("as_of_month") == F.lit(SNAPSHOT).cast("date"))
    return month.groupBy("monitoring_state", "origination_year").agg(F.count("*").alias("loans"))


_register(
    "stored_panel_month",
    _stored_month,
    statement(
        "select monitoring_state, origination_year, count(*) as loans from fact "
        f"where as_of_month = date '{SNAPSHOT}' group by 1, 2"
    ),
)

def _hidden_bounds(group: str, table: str, count: str) -> str:
    """Bounds of the cells that an export at 20 hides, by group."""
    return f"""
        select *, case when cells = 1 then together else least(
                 case when fits then greatest(0, together - (cells - 1) * 19) end,
                 case when joins then if(cells = 2, greatest(1, together - coalesce(shown, together)), 0) end) end as lower,
               case when cells = 1 then together else greatest(
                 case when fits then least(19, together) end,
                 case when joins then least(19, together - 20) end) end as upper
        from (select *, together <= cells * 19 and not (shown is not null and together between 1 and 19) as fits,
                cells > 1 and greatest(1, together - coalesce(shown, together)) <= least(19, together - 20) as joins
              from (select {group}, sum({count}) filter (privacy_merged) as together,
                      sum(source_mart_row_count) filter (privacy_merged) as cells,
                      min({count}) filter (not privacy_merged) as shown
                    from {table} group by all)
              where together > 0 or cells > 0)"""


def _disclosed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What exports at 20 and at 60 tell together."""
    both = {k: _segment_export(spark, sf_dir, k) for k in (20, 60)}
    return disclosure.segment_disclosures(both, _monthly(spark, sf_dir))


def _disclosed_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.transition_disclosures({20: _transition_export(spark, sf_dir)}, room=19)


_register(
    "disclosures_segments",
    _disclosed_segments,
    statement(
        "select as_of_month, segment_name, segment_value as cell, on_book_loan_count as lower, "
        f"on_book_loan_count as upper, '{disclosure.SHOWN}' as reason from segment_export "
        "where not privacy_merged and on_book_loan_count < 60 union all "
        "select as_of_month, segment_name, null, lower, upper, "
        f"if(together between 1 and 59, '{disclosure.TOTAL}', '{disclosure.BOUNDS}') "
        f"from ({_hidden_bounds('as_of_month, segment_name', 'segment_export', 'on_book_loan_count')}) "
        "where together between 1 and 59 or (upper - lower + 1 < 5 and together > 0)"
    ),
)
_register(
    "disclosures_transitions",
    _disclosed_transitions,
    statement(
        f"select from_month, from_state, cast(null as varchar) as cell, lower, upper, "
        f"if(together between 1 and 19, '{disclosure.TOTAL}', '{disclosure.BOUNDS}') as reason "
        f"from ({_hidden_bounds('from_month, from_state', 'transition_export', 'transition_loan_count')}) "
        "where together between 1 and 19 or (upper - lower + 1 < 19 and together > 0)"
    ),
)

def _damaged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files a stored report of damaged files rejects."""
    expected = {
        (dataset, year): n
        for dataset, years in panel.expected_rows(spark, sf_dir).items()
        for year, n in years.items()
    }
    folder = storage.scratch_dir(spark, "report")
    raw_dir = _raw_files(spark, sf_dir, lambda lines: lines.filter("mp % 211 <> 1 OR source_year <> 2019"))
    validate_raw(spark, raw_dir, expected, folder)
    files = raw_profile.read_report(spark, folder, "files")
    failures = raw_profile.read_report(spark, folder, "failures").filter("metric = 'row_count'")
    wrong = failures.select("dataset", "source_year", F.col("value").alias("found_rows"))
    return files.join(wrong, ["dataset", "source_year"], "left").select(
        "dataset", F.col("source_year").cast("int").alias("source_year"), "expected_fields", "found_rows"
    )


_register(
    "raw_report_stored",
    _damaged_report,
    statement(
        "select dataset, cast(year as integer) as source_year, "
        f"if(dataset = 'origination', {len(ORIGINATION_FIELDS)}, {len(PERFORMANCE_FIELDS)}) as expected_fields, "
        "if(dataset = 'performance' and year = 2019, "
        "(select count(*) from perf where source_year = 2019 and mp % 211 <> 1), null) as found_rows "
        "from (select unnest(['origination', 'performance']) as dataset) d, (select unnest([2019, 2020]) as year) y"
    ),
)


def _missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a delivery that a year has not arrived for, named by the one error of a build."""
    years = [*VINTAGES, max(VINTAGES) + 1]
    raw_dir = _raw_files(spark, sf_dir)
    try:
        delimited.require_files(spark, raw_dir, years)
    except FileNotFoundError as error:
        names = [line.rsplit("/", 1)[1] for line in str(error).splitlines() if line.startswith("- ")]
    rows = delimited.scan_performance(spark, raw_dir).agg(F.count("*").alias("rows_there"))
    return rows.select(F.explode(F.lit(names)).alias("missing"), "rows_there")


_register(
    "missing_files",
    _missing_files,
    statement(
        f"select unnest(['sample_orig_{max(VINTAGES) + 1}.txt', 'sample_perf_{max(VINTAGES) + 1}.txt']) as missing, "
        "(select count(*) from perf) as rows_there"
    ),
)


def _in_stored_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each month in the stored mart, whose parts are in order."""
    mart = _built(spark, sf_dir).store.read("mart.portfolio_monthly")
    placed = mart.select("as_of_month", F.struct("_metadata.file_name", F.monotonically_increasing_id().alias("id")).alias("at"))
    return placed.select("as_of_month", F.expr("row_number() OVER (ORDER BY at)").cast("bigint").alias("place"))


_register(
    "mart_in_key_order",
    _in_stored_order,
    statement("select as_of_month, row_number() over (order by as_of_month) as place from monthly"),
)

# Sums as whole cents, which no floating-point number stands between.
_register(
    "exact_totals",
    lambda s, d: panel.fact(s, d)
    .groupBy("as_of_month")
    .agg(
        (F.sum("current_actual_upb") * 100).cast("bigint").alias("cents"),
        F.max(F.expr("bigint(current_actual_upb * 100)")).alias("largest_cents"),
    ),
    statement(
        "select as_of_month, cast(sum(current_actual_upb) * 100 as bigint) as cents, "
        "cast(max(current_actual_upb) * 100 as bigint) as largest_cents from fact group by 1"
    ),
)
for _dimension in _SHOWN_LABELS:
    _register(
        f"panel_segment_in_full_{_dimension}",
        lambda s, d, dim=_dimension: panels.segment_panel_in_full(
            _segment_export(s, d, 60), SNAPSHOT, dim
        ).select("segment_value", *both_units(CORE[:2])),
        statement(
            f"select segment_value, {listed(both_units(CORE[:2]))} from segment_export "
            f"where as_of_month = date '{SNAPSHOT}' and segment_name = '{_dimension}'",
            k=60,
        ),
    )

_register(
    "raw_file_roundtrip",
    _file_roundtrip,
    statement(
        "select "
        + listed([c for c in _FACT_COLUMNS if not c.startswith(("origination_", "fico", "cltv", "dti"))])
        + ", is_valid_loan_age, 'sample_perf_' || source_year || '.txt' as file_name from perf"
    ),
)


def _built(spark: SparkSession, sf_dir: str) -> build_plan.BuildReport:
    expect = _expectations(spark, sf_dir)
    root = storage.scratch_dir(spark, "build")
    return build_plan.build(spark, _raw_files(spark, sf_dir), root, expect)


_register("full_rebuild", lambda s, d: _built(s, d).row_counts, _COUNTS_SQL)


_EXPORTED = {
    "monthly": lambda s, d: exports.export_monthly(_monthly(s, d)),
    "segments": _segment_export,
    "transitions": _transition_export,
}
_EXPORTED_SQL = {
    "monthly": (exports.MONTHLY_FIELDS, "monthly"),
    "segments": (exports.SEGMENT_FIELDS, "segment_export"),
    "transitions": (exports.TRANSITION_FIELDS, "transition_export"),
}


def _csv_roundtrip(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{storage.scratch_dir(spark, 'csv')}/{name}"
    write_csv(exports.in_display_order(_EXPORTED[name](spark, sf_dir)), path)
    return read_csv(spark, path, _EXPORTED_SQL[name][0])


for _name, (_columns, _source) in _EXPORTED_SQL.items():
    _register(
        f"csv_roundtrip_{_name}",
        partial(_csv_roundtrip, name=_name),
        statement(f"select {listed(_columns)} from {_source}"),
    )


def _published_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files through build, publication and export, as read back."""
    report = _built(spark, sf_dir)
    out_dir = storage.scratch_dir(spark, "export")
    dashboard.export(spark, report.store.root, out_dir)
    return dashboard.load_export(spark, out_dir).transitions


def _export_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports to one folder; the second is what a reader gets.

    A small panel has no cohort of 60 loans, and then the first one is rejected.
    """
    report = _built(spark, sf_dir)
    out_dir = storage.scratch_dir(spark, "export")
    with contextlib.suppress(dashboard.ExportRejected):
        dashboard.export(spark, report.store.root, out_dir, 60)
    dashboard.export(spark, report.store.root, out_dir, 20)
    return dashboard.load_export(spark, out_dir).transitions


def _export_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export after which one with a threshold beyond all cohorts is rejected."""
    report = _built(spark, sf_dir)
    out_dir = storage.scratch_dir(spark, "export")
    dashboard.export(spark, report.store.root, out_dir, 10)
    with contextlib.suppress(dashboard.ExportRejected):
        dashboard.export(spark, report.store.root, out_dir, 10**9)
    return dashboard.load_export(spark, out_dir).transitions


_register(
    "export_refreshed",
    _export_refreshed,
    statement(f"select {listed(exports.TRANSITION_FIELDS)} from transition_export", k=20),
)
_register(
    "export_rejected",
    _export_rejected,
    statement(f"select {listed(exports.TRANSITION_FIELDS)} from transition_export", k=10),
)
_register(
    "published_export",
    _published_export,
    statement(f"select {listed(exports.TRANSITION_FIELDS)} from transition_export"),
)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
