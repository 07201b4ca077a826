"""Typed staging of raw origination and monthly performance rows.

Both functions are one projection each: no shuffle, so staging a file set of
any size is a map-only job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.domain import PERCENT_MISSING, SCORE_MISSING, TERMINATED_PREFIX
from loanscope.functions.parsing import (
    MONEY,
    RATE,
    missing_reason,
    month,
    number,
    text,
    two_digit_number,
    whole,
    whole_unless,
)

# How each raw field becomes typed columns. A field may yield several columns;
# the order of this mapping is the column order of the staged table.
_PLAIN, _MONEY, _RATE, _SMALL, _MONTH = "plain", "money", "rate", "small", "month"

_ORIGINATION = {
    "classic_fico": "score",
    "first_payment_date": _MONTH,
    "first_time_homebuyer_indicator": _PLAIN,
    "maturity_date": _MONTH,
    "msa_or_metropolitan_division": "int",
    "mi_percentage": "percent",
    "number_of_units": _SMALL,
    "occupancy_status": _PLAIN,
    "original_cltv": "percent",
    "original_dti": "percent",
    "original_upb": _MONEY,
    "original_ltv": "percent",
    "original_interest_rate": _RATE,
    "channel": _PLAIN,
    "prepayment_penalty_indicator": _PLAIN,
    "amortization_type": _PLAIN,
    "property_state": _PLAIN,
    "property_type": _PLAIN,
    "postal_code": _PLAIN,
    "loan_purpose": _PLAIN,
    "original_loan_term": _SMALL,
    "number_of_borrowers": _SMALL,
    "seller_name": _PLAIN,
    "super_conforming_flag": _PLAIN,
    "pre_harp_loan_id": _PLAIN,
    "special_eligibility_program": _PLAIN,
    "harp_indicator": _PLAIN,
    "property_valuation_method": _PLAIN,
    "interest_only_indicator": _PLAIN,
    "vantage_score_4": "score",
}

_PERFORMANCE = {
    "period": "period",
    "current_actual_upb": _MONEY,
    "current_loan_delinquency_status": "status",
    "loan_age": "small_with_raw",
    "remaining_months_to_legal_maturity": _SMALL,
    "defect_settlement_date": _MONTH,
    "modification_flag": _PLAIN,
    "zero_balance_code": _PLAIN,
    "zero_balance_effective_date": _MONTH,
    "current_interest_rate": _RATE,
    "current_non_interest_bearing_upb": _MONEY,
    "ddlpi": _MONTH,
    "mi_recoveries": _MONEY,
    "net_sales_proceeds": _MONEY,
    "non_mi_recoveries": _MONEY,
    "total_expenses": _MONEY,
    "legal_costs": _MONEY,
    "maintenance_and_preservation_costs": _MONEY,
    "taxes_and_insurance": _MONEY,
    "miscellaneous_expenses": _MONEY,
    "actual_loss": _MONEY,
    "cumulative_modification_costs": _MONEY,
    "interest_rate_step_indicator": _PLAIN,
    "payment_deferral_flag": _PLAIN,
    "estimated_ltv": "ltv",
    "zero_balance_removal_upb": _MONEY,
    "delinquent_accrued_interest": _MONEY,
    "delinquency_due_to_disaster": _PLAIN,
    "borrower_assistance_plan": _PLAIN,
    "current_period_modification_costs": _MONEY,
    "current_interest_bearing_upb": _MONEY,
    "mi_cancellation_indicator": _PLAIN,
    "servicer_name": _PLAIN,
    "bankruptcy_cramdown_costs": _MONEY,
}


def _month_name(field: str) -> str:
    return f"{field.removesuffix('_date')}_month"


def _typed(field: str, kind: str) -> list[str]:
    keep_raw = f"{field} AS {field}_raw"
    match kind:
        case "plain":
            return [f"{text(field)} AS {field}"]
        case "money":
            return [f"{number(field, MONEY)} AS {field}"]
        case "rate":
            return [f"{number(field, RATE)} AS {field}"]
        case "ltv":
            return [f"{number(field, 'decimal(12,3)')} AS {field}"]
        case "small":
            return [f"{whole(field)} AS {field}"]
        case "small_with_raw":
            return [keep_raw, f"{whole(field)} AS {field}"]
        case "int":
            return [f"{whole(field, 'int')} AS {field}"]
        case "month":
            return [keep_raw, f"{month(field)} AS {_month_name(field)}"]
        case "period":
            return [keep_raw, f"{month(field)} AS as_of_month"]
        case "status":
            return [
                f"{text(field)} AS delinquency_status_raw",
                f"{two_digit_number(field)} AS delinquency_months",
            ]
        case "percent":
            return [keep_raw, f"{whole_unless(field, PERCENT_MISSING)} AS {field}"]
        case "score":
            return [
                keep_raw,
                f"{whole_unless(field, SCORE_MISSING)} AS {field}",
                f"{missing_reason(field, SCORE_MISSING)} AS {field}_missing_reason",
            ]
    raise ValueError(f"no typing rule for {kind!r}")


def _typed_columns(rules: dict[str, str]) -> list[str]:
    return [column for field, kind in rules.items() for column in _typed(field, kind)]


# Characters 2-3 of a loan id are its vintage; a malformed id raises, whatever the
# session says about failing casts. A missing id has no vintage.
VINTAGE_YEAR = (
    "if(loan_id IS NULL, NULL, coalesce(try_cast(concat('20', substring(loan_id, 2, 2)) AS smallint), "
    "raise_error(concat('no vintage in loan id ', loan_id))))"
)
VINTAGE_QUARTER = "substring(loan_id, 4, 2)"


def stage_origination(raw: DataFrame) -> DataFrame:
    """Type raw origination rows (31 text fields plus file lineage)."""
    return raw.selectExpr(
        "source_year",
        "source_file",
        "loan_id",
        f"{VINTAGE_YEAR} AS origination_year",
        f"{VINTAGE_QUARTER} AS origination_quarter",
        *_typed_columns(_ORIGINATION),
    )


def type_performance(raw: DataFrame) -> DataFrame:
    """Type raw performance rows (35 text fields plus file lineage)."""
    return raw.selectExpr("source_year", "source_file", "loan_id", *_typed_columns(_PERFORMANCE))


def is_on_book(upb: Column, zero_balance_code: Column) -> Column:
    """End-of-month on-book test; NULL for an unknown balance without a code."""
    return (upb > 0) & zero_balance_code.isNull()


def monitoring_state(
    zero_balance_code: Column, loan_age: Column, months: Column, status: Column
) -> Column:
    """One label per loan-month; the first rule that holds decides."""
    return (
        F.when(zero_balance_code.isNotNull(), F.concat(F.lit(TERMINATED_PREFIX), zero_balance_code))
        .when(loan_age.isNull() | (loan_age < 0), "UNKNOWN_LOAN_AGE")
        .when((months == 0) & (loan_age == 0), "PRE_DUE")
        .when(months == 0, "CURRENT")
        .when(months == 1, "30")
        .when(months == 2, "60")
        .when(months > 2, "90+")
        .when(status == "RA", "REO_ACQUISITION")
        .otherwise("UNKNOWN")
    )


def flag_performance(typed: DataFrame) -> DataFrame:
    """Add the monitoring flags and state to typed performance rows.

    Flags follow SQL three-valued logic: an unknown balance gives an unknown
    on-book flag, which filters and filtered aggregates treat as false.
    """
    upb, code = F.col("current_actual_upb"), F.col("zero_balance_code")
    age, months = F.col("loan_age"), F.col("delinquency_months")
    on_book = is_on_book(upb, code)
    flags = {
        "is_terminal_record": code.isNotNull(),
        "is_on_book_eom": on_book,
        "is_numeric_delinquency_status": months.isNotNull(),
        "is_valid_loan_age": age.isNotNull() & (age >= 0),
        "is_delinquency_eligible": on_book & (age >= 1) & months.isNotNull(),
        "monitoring_state": monitoring_state(code, age, months, F.col("delinquency_status_raw")),
    }
    if "bankruptcy_cramdown_costs" in typed.columns:
        flags["dq_cramdown_populated_non_terminal"] = (
            F.col("bankruptcy_cramdown_costs").isNotNull() & code.isNull()
        )
    return typed.withColumns(flags)


def stage_performance(raw: DataFrame) -> DataFrame:
    """Typed performance rows with flags and monitoring state."""
    return flag_performance(type_performance(raw))
