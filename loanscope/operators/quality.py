"""Data-quality and reconciliation checks.

Every check reports ``check_name, failed_row_count, details``; a check passes
when the count is zero. Checks that only look at single rows share one pass over
their table. Checks of loan-month keys, coverage and adjacency share one reduction of
the staged rows to a bitmap of months per loan (see ``loan_months``), so an exchange
carries loans, and a repeated id costs partial results and never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.domain import (
    NON_NUMERIC_STATUSES,
    PERCENT_MISSING,
    SCORE_MISSING,
    SEGMENTS,
    VINTAGES,
    ZERO_BALANCE_CODES,
)
from loanscope.functions.measures import TOTAL, total, total_where
from loanscope.functions.parsing import TWO_DIGITS
from loanscope.operators.loan_months import (
    adjacent_count,
    loan_months,
    repeated_loan_months,
    word_count,
)
from loanscope.operators.marts import COHORT, CORE_MEASURES, UNSOUND_PAIRS
from loanscope.operators.staging import is_on_book
from loanscope.sources.storage import scratch_dir, written

RATE_TOLERANCE = 1e-10


@dataclass(frozen=True)
class Layers:
    """The tables a build produces, as the checks see them.

    A check only needs the tables it reads; the others may be left out.
    """

    origination: DataFrame | None = None
    performance: DataFrame | None = None
    fact: DataFrame | None = None
    pairs: DataFrame | None = None
    monthly: DataFrame | None = None
    segments: DataFrame | None = None
    transitions: DataFrame | None = None
    #: Reductions that several checks share; derived where they are not given.
    origination_pass: DataFrame | None = None
    performance_pass: DataFrame | None = None
    loan_months: DataFrame | None = None
    flows: DataFrame | None = None


@dataclass(frozen=True)
class Expectations:
    """What the checks compare the data with."""

    origination_rows: dict[int, int]
    performance_rows: dict[int, int]
    window_end: str
    spot_months: list[str]


def _either(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# --- row rules: condition that makes a row a failure --------------------------


def _coded_out_of_range(field: str, code: str, low: int, high: int) -> Column:
    raw, value = F.col(f"{field}_raw"), F.col(field)
    return ((raw == code) & value.isNotNull()) | ((raw != code) & ~value.between(low, high))


def risk_fields_invalid() -> Column:
    upb = F.col("original_upb")
    return _either(
        _coded_out_of_range("classic_fico", SCORE_MISSING, 300, 850),
        _coded_out_of_range("original_cltv", PERCENT_MISSING, 1, 998),
        _coded_out_of_range("original_dti", PERCENT_MISSING, 0, 65),
        upb.isNull() | (upb <= 0),
    )


def month_invalid(window_end: str) -> Column:
    month = F.col("as_of_month")
    vintage_start = F.make_date(F.col("source_year").cast("int"), F.lit(1), F.lit(1))
    return month.isNull() | (month < vintage_start) | (month > F.lit(window_end).cast("date"))


def status_invalid() -> Column:
    status = F.col("delinquency_status_raw")
    return status.isNull() | ~(status.rlike(TWO_DIGITS) | status.isin(NON_NUMERIC_STATUSES))


def zero_balance_code_invalid() -> Column:
    code = F.col("zero_balance_code")
    return code.isNotNull() & ~code.isin(ZERO_BALANCE_CODES)


def on_book_inconsistent() -> Column:
    upb, code = F.col("current_actual_upb"), F.col("zero_balance_code")
    effective = F.col("zero_balance_effective_month")
    return _either(
        upb.isNull() | (upb < 0),
        code.isNull() != effective.isNull(),
        ~F.col("is_on_book_eom").eqNullSafe(is_on_book(upb, code)),
    )


def eligible_off_book() -> Column:
    return F.col("is_delinquency_eligible") & _either(
        ~F.col("is_on_book_eom"),
        F.col("loan_age") < 1,
        ~F.col("is_numeric_delinquency_status"),
    )


def hierarchy_broken(unit: str) -> Column:
    nested = [f"{p}_{unit}" for p in ("delinquency_eligible", "dq30", "dq60", "dq90")]
    return _either(*(F.col(inner) > F.col(outer) for outer, inner in zip(nested, nested[1:])))


def pair_not_adjacent() -> Column:
    return F.expr(UNSOUND_PAIRS["pairs_not_adjacent"])


def pair_source_off_book() -> Column:
    return F.expr(UNSOUND_PAIRS["pair_sources_off_book"])


def vintage_disagrees() -> Column:
    return F.col("origination_year") != F.col("source_year")


def count_rule_failures(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Failing rows per rule, in one pass: ``check_name, failed_row_count``.

    Rows that carry ``pair_count`` count that many times.
    """
    weighted = "pair_count" in rows.columns

    def failures(rule: Column) -> Column:
        if weighted:
            return F.coalesce(F.sum(F.when(rule, F.col("pair_count"))), F.lit(0)).cast("bigint")
        return F.count_if(rule)

    counts = rows.agg(*(failures(rule).alias(name) for name, rule in rules.items()))
    results = (
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failed_row_count"))
        for name in rules
    )
    return counts.select(F.inline(F.array(*results)))


# --- checks over keys, sets and totals ----------------------------------------


def row_count(rows: DataFrame, check_name: str) -> DataFrame:
    """One result row whose failure count is the number of rows given."""
    return rows.agg(F.count("*").alias("failed_row_count")).select(
        F.lit(check_name).alias("check_name"), "failed_row_count"
    )


def key_failures(rows: DataFrame, key: list[str]) -> DataFrame:
    """Key values that are incomplete or occur more than once."""
    incomplete = _either(*(F.col(part).isNull() for part in key))
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter(incomplete | (F.col("n") > 1))


def _rule_counts(rules: dict[str, Column]) -> list[Column]:
    return [F.count_if(rule).alias(name) for name, rule in rules.items()]


def origination_pass(origination: DataFrame) -> DataFrame:
    """Rows and failing rows per file year, in one scan."""
    rules = {
        "origination_risk_fields_valid": risk_fields_invalid(),
        "vintage_matches_file_year": vintage_disagrees(),
    }
    return origination.groupBy("source_year").agg(F.count("*").alias("rows"), *_rule_counts(rules))


def performance_pass(performance: DataFrame, expect: Expectations) -> DataFrame:
    """Rows, failing rows and core measures per file year and spot month, in one scan.

    ``spot_month`` is NULL for the other months; measures use no flags.
    """
    rules = _row_rules(expect)
    spots = [F.lit(month).cast("date") for month in expect.spot_months]
    spot = F.when(F.col("as_of_month").isin(spots), F.col("as_of_month")) if spots else F.lit(None)
    return performance.groupBy("source_year", spot.cast("date").alias("spot_month")).agg(
        F.count("*").alias("rows"),
        *_rule_counts({name: rules[name]() for name in sorted(_PERFORMANCE_RULES)}),
        *_plain_measures(),
    )


def reduced_months(performance: DataFrame, expect: Expectations) -> DataFrame:
    """The months of every loan, with room for all that a build expects."""
    first_year = min([*expect.performance_rows, *expect.origination_rows, *VINTAGES])
    return loan_months(performance, word_count(first_year, expect.window_end), first_year)


def summed_failures(passed: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``check_name, failed_row_count`` from columns of a reduced table, by check name."""
    sums = passed.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns.values())
    )
    results = (
        F.struct(F.lit(name).alias("check_name"), F.col(c).alias("failed_row_count"))
        for name, c in columns.items()
    )
    return sums.select(F.inline(F.array(*results)))


def count_mismatch(
    originations: DataFrame, performances: DataFrame, expect: Expectations
) -> DataFrame:
    """One row if any expected row count per file year is not met, else none.

    Takes the reductions of the two tables.
    """
    expected = [
        ("origination", year, rows) for year, rows in expect.origination_rows.items()
    ] + [("performance", year, rows) for year, rows in expect.performance_rows.items()]
    values = ", ".join(f"('{dataset}', {year}S, {rows}L)" for dataset, year, rows in expected)
    wanted = originations.sparkSession.sql(
        f"SELECT * FROM VALUES {values} AS wanted(dataset, source_year, rows)"
        if expected
        else "SELECT '' AS dataset, 0S AS source_year, 0L AS rows WHERE false"
    )

    def counted(reduced: DataFrame, dataset: str) -> DataFrame:
        return reduced.groupBy("source_year").agg(F.sum("rows").alias("found")).select(
            F.lit(dataset).alias("dataset"), "source_year", "found"
        )

    found = counted(originations, "origination").unionByName(counted(performances, "performance"))
    unmet = F.coalesce("found", F.lit(0)) != F.col("rows")
    return (
        wanted.join(found, ["dataset", "source_year"], "left")
        .agg(F.bool_or(unmet).alias("unmet"))
        .filter("unmet")
    )


def uncovered_loans(origination: DataFrame, observed: DataFrame) -> DataFrame:
    """Loans of one side only, with the rows they stand for (``failures``).

    ``observed`` has the performance ids once each. An origination id counts once per
    origination row, a performance id once; a missing id matches nothing. An id that
    repeats without end still reaches the join as one row, and one join answers both
    directions.
    """
    observed = observed.select("loan_id", F.lit(True).alias("observed"))
    originated = origination.groupBy("loan_id").agg(F.count("*").alias("originations"))
    return (
        originated.join(observed, "loan_id", "full")
        .filter("originations IS NULL OR observed IS NULL")
        .select("loan_id", F.coalesce("originations", F.lit(1)).cast("bigint").alias("failures"))
    )


def segment_rollup(segments: DataFrame) -> DataFrame:
    """Core measures of a segment table summed back to month and dimension."""
    return segments.groupBy("as_of_month", "segment_name").agg(
        *(
            (total(F.col(m)) if m.endswith("upb") else F.sum(m)).alias(m)
            for m in CORE_MEASURES
        )
    )


def absent_dimensions(monthly: DataFrame, segments: DataFrame) -> DataFrame:
    """(month, dimension) combinations that the segment mart lacks."""
    wanted = monthly.select(
        "as_of_month",
        F.explode(F.array(*(F.lit(name) for name in SEGMENTS))).alias("segment_name"),
    )
    present = segments.select("as_of_month", "segment_name").distinct()
    return wanted.join(present, ["as_of_month", "segment_name"], "left_anti")


def measures_differ(left: DataFrame, monthly: DataFrame) -> DataFrame:
    """Rows whose core measures differ from the monthly table's for that month."""
    months = monthly.select("as_of_month", *(F.col(m).alias(f"mart_{m}") for m in CORE_MEASURES))
    differs = _either(*(F.col(m) != F.col(f"mart_{m}") for m in CORE_MEASURES))
    return left.join(months, "as_of_month").filter(differs)


def _plain_measures() -> list[Column]:
    """Core measures straight from staged fields, without flags."""
    on_book = "current_actual_upb > 0 AND zero_balance_code IS NULL"
    seasoned = f"{on_book} AND loan_age >= 1"
    populations = {
        "on_book": on_book,
        "delinquency_eligible": f"{seasoned} AND delinquency_status_raw RLIKE r'{TWO_DIGITS}'",
        **{
            f"dq{30 * n}": f"{seasoned} AND try_cast(delinquency_status_raw AS int) >= {n}"
            for n in (1, 2, 3)
        },
    }
    measures = []
    for name, condition in populations.items():
        measures.append(F.expr(f"count_if({condition}) AS {name}_loan_count"))
        measures.append(
            F.expr(f"{total_where(condition, 'current_actual_upb')} AS {name}_upb")
        )
    return measures


def recalculated_months(reduced: DataFrame) -> DataFrame:
    """Core measures of the spot months, from the reduction of the staged rows."""
    sums = (
        (total(F.col(m)) if m.endswith("upb") else F.sum(m)).alias(m) for m in CORE_MEASURES
    )
    return (
        reduced.filter("spot_month IS NOT NULL")
        .groupBy(F.col("spot_month").alias("as_of_month"))
        .agg(*sums)
    )


def unbalanced_cohorts(transitions: DataFrame) -> DataFrame:
    """Cohorts whose flows do not add up to their denominators."""
    sums = transitions.groupBy(*COHORT).agg(
        F.sum("transition_loan_count").alias("flows"),
        F.max("observable_from_state_loan_count").alias("cohort"),
        total(F.col("transition_from_upb")).alias("flow_upb"),
        F.max("observable_from_state_upb").alias("cohort_upb"),
    )
    return sums.filter("flows <> cohort OR flow_upb <> cohort_upb")


def unnormalised_cohorts(transitions: DataFrame) -> DataFrame:
    """Cohorts whose rates do not sum to one."""
    off_by = {
        f"{kind}_gap": F.abs(F.sum(f"transition_{kind}_rate") - F.lit(1.0))
        for kind in ("count", "balance")
    }
    gaps = transitions.groupBy(*COHORT).agg(*(gap.alias(name) for name, gap in off_by.items()))
    return gaps.filter(_either(*(F.col(name) > RATE_TOLERANCE for name in off_by)))


# --- fixed check names, in report order ---------------------------------------

DETAILS = {
    "source_row_counts": "Rows per file year must equal the expected counts.",
    "origination_loan_id_unique": "Each origination row needs its own loan id.",
    "performance_loan_month_unique": "A loan has at most one row per month, with both parts known.",
    "origination_performance_coverage": "Loans occur in the origination and the performance files.",
    "origination_risk_fields_valid": "Scores, ratios and original balance lie in their ranges.",
    "performance_months_valid": "Months run from the vintage year to the end of the window.",
    "delinquency_statuses_valid": "A status is two digits, RA or XX.",
    "zero_balance_codes_valid": "Zero-balance codes come from the documented list.",
    "on_book_population_consistent": "Balance, zero-balance fields and on-book flag agree.",
    "eligible_population_is_on_book": "Eligible rows are on book, seasoned and numeric.",
    "delinquency_count_hierarchy": "Loan counts fall from eligible to 30+, 60+ and 90+.",
    "delinquency_upb_hierarchy": "Balances fall from eligible to 30+, 60+ and 90+.",
    "segment_dimensions_complete": "Every month has all four segment dimensions.",
    "segment_totals_reconcile": "Segments of a dimension add up to the monthly totals.",
    "monthly_metric_spot_checks": "Chosen months recomputed from staging equal the mart.",
    "transition_pairs_are_adjacent_months": "Pairs lie one calendar month apart.",
    "transition_sources_are_on_book": "Pairs start from a positive balance that is not terminated.",
    "transition_cohort_totals_reconcile": "Flows add up to the cohort they leave.",
    "transition_rates_sum_to_one": "Rates of a cohort sum to one.",
}

# Checks of single rows, grouped by the table they read.
_PERFORMANCE_RULES = {
    "performance_months_valid",
    "delinquency_statuses_valid",
    "zero_balance_codes_valid",
    "on_book_population_consistent",
}
_HIERARCHY_RULES = {"delinquency_count_hierarchy", "delinquency_upb_hierarchy"}
# The columns of the flows that count the failures.
_PAIR_RULES = {
    "transition_pairs_are_adjacent_months": "pairs_not_adjacent",
    "transition_sources_are_on_book": "pair_sources_off_book",
}


def _row_rules(expect: Expectations) -> dict[str, Callable[[], Column]]:
    return {
        "origination_risk_fields_valid": risk_fields_invalid,
        "performance_months_valid": lambda: month_invalid(expect.window_end),
        "delinquency_statuses_valid": status_invalid,
        "zero_balance_codes_valid": zero_balance_code_invalid,
        "on_book_population_consistent": on_book_inconsistent,
        "eligible_population_is_on_book": eligible_off_book,
        "delinquency_count_hierarchy": lambda: hierarchy_broken("loan_count"),
        "delinquency_upb_hierarchy": lambda: hierarchy_broken("upb"),
        "transition_pairs_are_adjacent_months": pair_not_adjacent,
        "transition_sources_are_on_book": pair_source_off_book,
    }


def _nested_measures(layers: Layers) -> DataFrame:
    populations = ("delinquency_eligible", "dq30", "dq60", "dq90")
    columns = [f"{p}_{unit}" for unit in ("loan_count", "upb") for p in populations]
    return layers.monthly.select(*columns).unionByName(layers.segments.select(*columns))


def failure_counts(
    layers: Layers, expect: Expectations, only: Iterable[str] | None = None
) -> DataFrame:
    """``check_name, failed_row_count`` of the chosen checks (all by default)."""
    chosen = set(DETAILS if only is None else only)
    unknown = chosen - set(DETAILS)
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")

    rules = _row_rules(expect)

    def _shared(name: str, passed: DataFrame) -> DataFrame:
        """A small reduction, stored if several checks read it, so that rows are scanned once."""
        if len(chosen) == 1:
            return passed
        return written(passed, f"{scratch_dir(passed.sparkSession, 'passes')}/{name}")

    @cache
    def originations() -> DataFrame:
        given = layers.origination_pass
        return _shared("origination", origination_pass(layers.origination)) if given is None else given

    @cache
    def performances() -> DataFrame:
        given = layers.performance_pass
        return _shared("performance", performance_pass(layers.performance, expect)) if given is None else given

    @cache
    def months() -> DataFrame:
        if layers.loan_months is not None:
            return layers.loan_months
        reduced = reduced_months(layers.performance, expect)
        return written(reduced, f"{scratch_dir(reduced.sparkSession, 'months')}/loan_months")

    def wanted(names: Iterable[str]) -> dict[str, str]:
        return {name: name for name in DETAILS if name in names and name in chosen}

    results = []
    if columns := wanted({"origination_risk_fields_valid"}):
        results.append(summed_failures(originations(), columns))
    if columns := wanted(_PERFORMANCE_RULES):
        results.append(summed_failures(performances(), columns))
    row_checks: list[tuple[Callable[[], DataFrame], set[str]]] = [
        (lambda: layers.fact, {"eligible_population_is_on_book"}),
        (lambda: _nested_measures(layers), _HIERARCHY_RULES),
    ]
    if layers.flows is None:
        row_checks.append((lambda: layers.pairs, set(_PAIR_RULES)))
    elif columns := wanted(_PAIR_RULES):
        counted = {name: _PAIR_RULES[name] for name in columns}
        results.append(summed_failures(layers.flows, counted))
    results += [
        count_rule_failures(rows(), {name: rules[name]() for name in names})
        for rows, group in row_checks
        if (names := wanted(group))
    ]
    set_checks: dict[str, Callable[[], DataFrame]] = {
        "source_row_counts": lambda: count_mismatch(originations(), performances(), expect),
        "origination_loan_id_unique": lambda: key_failures(layers.origination, ["loan_id"]),
        "performance_loan_month_unique": lambda: repeated_loan_months(layers.performance, months()),
        "segment_dimensions_complete": lambda: absent_dimensions(layers.monthly, layers.segments),
        "segment_totals_reconcile": lambda: measures_differ(
            segment_rollup(layers.segments), layers.monthly
        ),
        "monthly_metric_spot_checks": lambda: measures_differ(
            recalculated_months(performances()), layers.monthly
        ),
        "transition_cohort_totals_reconcile": lambda: unbalanced_cohorts(layers.transitions),
        "transition_rates_sum_to_one": lambda: unnormalised_cohorts(layers.transitions),
    }
    results += [
        row_count(rows(), name) for name, rows in set_checks.items() if name in chosen
    ]
    if "origination_performance_coverage" in chosen:
        uncovered = uncovered_loans(layers.origination, months())
        results.append(
            uncovered.agg(F.coalesce(F.sum("failures"), F.lit(0)).alias("failed_row_count")).select(
                F.lit("origination_performance_coverage").alias("check_name"), "failed_row_count"
            )
        )
    return reduce(DataFrame.unionByName, results)


def validation_results(
    layers: Layers, expect: Expectations, only: Iterable[str] | None = None
) -> DataFrame:
    """Check report: ``check_name, failed_row_count, passed, details, checked_at``."""
    return reported(failure_counts(layers, expect, only), DETAILS)


def reported(counts: DataFrame, details: dict[str, str]) -> DataFrame:
    text = F.create_map(*(F.lit(part) for item in details.items() for part in item))
    return counts.select(
        "check_name",
        "failed_row_count",
        (F.col("failed_row_count") == 0).alias("passed"),
        F.element_at(text, F.col("check_name")).alias("details"),
        F.current_timestamp().alias("checked_at"),
    )


def failed_checks(results: DataFrame) -> DataFrame:
    return (
        results.filter(~F.col("passed"))
        .select("check_name", "failed_row_count", "details")
        .orderBy("check_name")
    )


def validation_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("checks"), F.count_if("passed").alias("passed"))


def vintage_disagreements(origination: DataFrame) -> DataFrame:
    """Originations whose id names another vintage than their file does."""
    return origination.filter(vintage_disagrees())


def population_identity_failures(monthly: DataFrame) -> DataFrame:
    """Months in which on-book loans are not split exactly into eligible and excluded."""
    parts = [
        "delinquency_eligible",
        "excluded_loan_age_zero",
        "excluded_invalid_loan_age",
        "excluded_non_numeric_status",
    ]

    def uneven(unit: str) -> Column:
        split = reduce(lambda a, b: a + b, (F.col(f"{part}_{unit}") for part in parts))
        return F.col(f"on_book_{unit}") != split.cast(TOTAL if unit == "upb" else "bigint")

    return monthly.filter(
        uneven("loan_count")
        | uneven("upb")
        | (F.col("excluded_pre_due_loan_count") > F.col("excluded_loan_age_zero_loan_count"))
    )


#: Checks beside the 19, which a build must pass as well.
EXTRA_DETAILS = {
    "vintage_matches_file_year": "A loan id names the vintage of its file.",
    "population_identity": "On-book loans split exactly into eligible and excluded ones.",
    "transition_pairs_complete": "Pairs are as many as on-book months with a next month.",
}


def missing_pairs(reduced: DataFrame, flows: DataFrame) -> DataFrame:
    """By how much the pairs of the flows differ in number from those that bitmaps show."""
    due = reduced.agg(F.coalesce(F.sum(adjacent_count()), F.lit(0)).cast("bigint").alias("n"))
    found = flows.agg(F.coalesce(F.sum(-F.col("transition_loan_count")), F.lit(0)).alias("n"))
    return due.unionByName(found).agg(F.abs(F.sum("n")).alias("failed_row_count")).select(
        F.lit("transition_pairs_complete").alias("check_name"), "failed_row_count"
    )


def extra_results(layers: Layers) -> DataFrame:
    """Report of the checks beside the 19, from the reductions and the monthly mart.

    Pairs are counted where both the flows and the months of loans are given. That holds for
    unique loan-months, which the key checks see to.
    """
    originations = layers.origination_pass
    if originations is None:
        originations = origination_pass(layers.origination)
    name = "vintage_matches_file_year"
    vintages = summed_failures(originations, {name: name})
    identity = row_count(population_identity_failures(layers.monthly), "population_identity")
    counts = vintages.unionByName(identity)
    if layers.loan_months is not None and layers.flows is not None:
        counts = counts.unionByName(missing_pairs(layers.loan_months, layers.flows))
    return reported(counts, EXTRA_DETAILS)
