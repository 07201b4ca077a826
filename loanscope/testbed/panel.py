"""Loan panel derived from the TPC-H style ``lineitem``, ``orders`` and ``customer``.

One loan per customer and one loan-month per customer and shipment month; all
attributes are arithmetic on the customer key ``k`` and on the smallest part key
``mp`` shipped in the month, so that Spark and a SQL oracle see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.domain import ORIGINATION_FIELDS, PERFORMANCE_FIELDS, ZERO_BALANCE_CODES
from loanscope.operators.curated import dim_loan, fact_loan_month
from loanscope.operators.staging import flag_performance, stage_origination

# Facts of the derived panel that checks take as parameters.
WINDOW_END = "2025-11-01"
SPOT_MONTHS = ["2020-06-01", "2021-06-01", "2025-11-01"]
MONTH_COUNT = 83
FIRST_MONTH = "2019-01-01"


# The columns read, typed up front so that reading needs no look at file footers.
_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_extendedprice double, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Loan attributes as functions of the customer key.
_YEAR = "smallint(2019 + k % 2)"
# Seven digits or more; a format string costs many times the padding and serves what is rare.
_SERIAL = "if(k BETWEEN 0 AND 9999999, lpad(k, 7, '0'), format_string('%07d', bigint(k)))"
_LOAN_ID = f"concat('F', {_YEAR} % 100, 'Q', k % 4 + 1, {_SERIAL})"
_CODES = ", ".join(f"'{code}'" for code in ZERO_BALANCE_CODES)


#: Order lines that one task sorts or groups, at most on average.
LINES_OF_PARTITION = 150_000


def partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions that what is derived from the lines needs, None if the session has enough.

    With the number of the session alone, tasks would grow with the tables.
    """
    wanted = -(-table(spark, sf_dir, "lineitem").count() // LINES_OF_PARTITION)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def spread(rows: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows hash-partitioned by the keys, for None as the session and the planner choose."""
    return rows if parts is None else rows.repartition(parts, *keys)


def _shipped_lines(spark: SparkSession, sf_dir: str, parts: int | None) -> DataFrame:
    """``k, as_of_month, l_partkey, cents`` of each line from the loan's first year on."""
    shipped = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        # Prices have two decimals; whole cents add up exactly and in long arithmetic.
        "bigint(l_extendedprice * 100 + 0.5) AS cents",
        "add_months(trunc(date(l_shipdate), 'month'), 24 * 12) AS as_of_month",
    )
    placed = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS k")
    # Partitions are bounded, so the orders of one fit in memory and no line is sorted.
    joined = spread(shipped, parts, "l_orderkey").join(placed.hint("shuffle_hash"), "l_orderkey")
    return joined.filter(f"as_of_month >= make_date({_YEAR}, 1, 1)")


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed loan-months without flags, with the generating ``k`` and ``mp``."""
    parts = partitions(spark, sf_dir)
    lines = _shipped_lines(spark, sf_dir, parts).selectExpr("*", f"{_LOAN_ID} AS loan_id")
    # One exchange by loan serves the months, their order and joins with the loans. Few lines
    # share a month, so reducing them ahead of it would not save much.
    by_loan = lines.repartition("loan_id") if parts is None else lines.repartition(parts, "loan_id")
    monthly = by_loan.groupBy("loan_id", "k", "as_of_month").agg(
        F.min("l_partkey").alias("mp"), F.sum("cents").alias("cents")
    )
    # At most one row per calendar month and loan here, so loan groups are small.
    first_month = F.first("as_of_month").over(Window.partitionBy("loan_id").orderBy("as_of_month"))
    aged = monthly.select("*", first_month.alias("first_month")).selectExpr(
        "*",
        "12 * (year(as_of_month) - year(first_month)) + month(as_of_month) - month(first_month)"
        " AS age",
        "CASE WHEN mp % 37 = 0 THEN 'XX' WHEN mp % 41 = 0 THEN 'RA'"
        " WHEN mp % 3 = 0 THEN lpad(string(mp div 3 % 6), 2, '0') ELSE '00' END AS status",
        f"if(mp % 29 = 0, element_at(array({_CODES}), int(mp % 7 + 1)), NULL) AS code",
    )
    return aged.selectExpr(
        "k",
        "mp",
        f"{_YEAR} AS source_year",
        "'panel' AS source_file",
        "loan_id",
        "as_of_month",
        "cast(if(mp % 101 = 0, 0, cents) * 0.01BD AS decimal(18,2)) AS current_actual_upb",
        "status AS delinquency_status_raw",
        "if(status IN ('RA', 'XX'), NULL, try_cast(status AS smallint)) AS delinquency_months",
        "if(mp % 89 = 0, NULL, smallint(age)) AS loan_age",
        "code AS zero_balance_code",
        "if(code IS NULL, NULL, as_of_month) AS zero_balance_effective_month",
    )


# Patterns that the SQL oracle spells alike, so that no field is always blank.
ORIGINATION_MORE = {
    "super_conforming_flag": "if(k % 17 = 0, 'Y', '')",
    "pre_harp_loan_id": "if(k % 19 = 0, concat('F99Q1', k % 1000), '')",
    "special_eligibility_program": "if(k % 23 = 0, 'H', '')",
    "harp_indicator": "if(k % 29 = 0, 'Y', '')",
    "property_valuation_method": "concat('', k % 3 + 1)",
    "interest_only_indicator": "if(k % 31 = 0, 'Y', 'N')",
}
PERFORMANCE_MORE = {
    "interest_rate_step_indicator": "if(mp % 53 = 0, 'Y', '')",
    "payment_deferral_flag": "if(mp % 61 = 0, 'P', '')",
    "delinquency_due_to_disaster": "if(mp % 67 = 0, 'Y', '')",
    "borrower_assistance_plan": "if(mp % 71 = 0, 'T', '')",
    "mi_cancellation_indicator": "if(mp % 73 = 0, 'Y', 'N')",
}
_AMOUNT_FIELDS = [
    "mi_recoveries", "net_sales_proceeds", "non_mi_recoveries", "total_expenses", "legal_costs",
    "maintenance_and_preservation_costs", "taxes_and_insurance", "miscellaneous_expenses",
    "cumulative_modification_costs", "zero_balance_removal_upb", "delinquent_accrued_interest",
    "current_period_modification_costs", "current_interest_bearing_upb",
]
# Each amount its own, blank in part of the rows.
PERFORMANCE_AMOUNTS = {
    name: f"if(mp % {7 + i} = 0, concat((mp + k) % {1000 + 17 * i} + {i}, '.{i + 10}'), '')"
    for i, name in enumerate(_AMOUNT_FIELDS)
}
# A month of settlement, or blank.
SETTLEMENT = "if(mp % 43 = 0, concat(2020 + mp % 5, '0', mp % 9 + 1), '')"

# Raw text of the origination fields; most are small patterns in ``k``.
ORIGINATION_TEXT = {
    "classic_fico": "CASE WHEN k % 97 = 0 THEN '9999' WHEN k % 89 = 0 THEN ''"
    " ELSE string(k * 37 % 291 + 560) END",
    "first_payment_date": f"concat({_YEAR}, lpad(k % 12 + 1, 2, '0'))",
    "first_time_homebuyer_indicator": "if(k % 5 = 0, 'Y', 'N')",
    "maturity_date": f"concat({_YEAR} + 30, lpad(k % 12 + 1, 2, '0'))",
    "msa_or_metropolitan_division": "if(k % 13 = 0, '', string(k % 900 * 37 + 10180))",
    "mi_percentage": "if(k % 61 = 0, '999', string(k % 4 * 6))",
    "number_of_units": "string(k % 4 + 1)",
    "occupancy_status": "CASE WHEN k % 7 = 0 THEN 'S' WHEN k % 11 = 0 THEN 'I' ELSE 'P' END",
    "original_cltv": "if(k % 83 = 0, '999', string(k * 53 % 66 + 35))",
    "original_dti": "if(k % 71 = 0, '999', string(k * 29 % 61 + 5))",
    "original_upb": "string(k * 7919 % 500000 + 50000)",
    "original_ltv": "if(k % 79 = 0, '999', string(k * 53 % 66 + 30))",
    "original_interest_rate": "concat(k % 4 + 2, '.', lpad(k % 1000, 3, '0'))",
    "channel": "element_at(array('R', 'B', 'C'), int(k % 3 + 1))",
    "prepayment_penalty_indicator": "if(k % 53 = 0, NULL, 'N')",
    "amortization_type": "'FRM'",
    "property_state": "if(k % 2 = 0, 'CA', 'TX')",
    "property_type": "if(k % 6 = 0, 'CO', 'SF')",
    "postal_code": "concat(lpad(k % 1000, 3, '0'), '00')",
    "loan_id": _LOAN_ID,
    "loan_purpose": "if(k % 4 = 0, 'C', 'P')",
    "original_loan_term": "if(k % 6 = 0, '180', '360')",
    "number_of_borrowers": "string(k % 2 + 1)",
    "seller_name": "concat('Seller ', k % 20)",
    "vantage_score_4": "if(k % 43 = 0, '9999', string(k * 31 % 301 + 540))",
    **ORIGINATION_MORE,
}



def _year_month(day: str) -> str:
    """``yyyyMM``, without the cost of a format pattern."""
    return f"string(year({day}) * 100 + month({day}))"


# Raw text of the performance fields.
_PERFORMANCE_TEXT = {
    "loan_id": "loan_id",
    "period": _year_month("as_of_month"),
    "current_actual_upb": "string(current_actual_upb)",
    "current_loan_delinquency_status": "delinquency_status_raw",
    "loan_age": "coalesce(string(loan_age), '')",
    "remaining_months_to_legal_maturity": "string(360 - mp % 83)",
    "modification_flag": "if(mp % 47 = 0, 'Y', '')",
    "zero_balance_code": "coalesce(zero_balance_code, '')",
    "zero_balance_effective_date": f"coalesce({_year_month('zero_balance_effective_month')}, '')",
    "current_interest_rate": "concat(k % 4 + 2, '.5')",
    "current_non_interest_bearing_upb": "'0.00'",
    "ddlpi": _year_month("as_of_month"),
    "estimated_ltv": "string(mp % 90 + 10)",
    "servicer_name": "concat('Servicer ', k % 10)",
    "actual_loss": "if(mp % 29 = 0, concat(mp % 5000, '.25'), '')",
    "bankruptcy_cramdown_costs": "if(mp % 59 = 0, '12.50', '')",
    "defect_settlement_date": SETTLEMENT,
    **PERFORMANCE_MORE,
    **PERFORMANCE_AMOUNTS,
}


def expected_rows(spark: SparkSession, sf_dir: str) -> dict[str, dict[int, int]]:
    """Rows per dataset and file year, counted from the source tables alone."""
    parts = partitions(spark, sf_dir)
    placed = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey AS k")
    months = (
        spread(table(spark, sf_dir, "lineitem"), parts, "l_orderkey")
        .join(placed.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr("k", "2019 + k % 2 AS year", "12 * (year(l_shipdate) + 24) + month(l_shipdate) AS month")
        .filter("month > 12 * year")
    )
    # By loan first: two distinct counts side by side would copy each line for either.
    by_loan = spread(months, parts, "k").groupBy("year", "k").agg(F.count_distinct("month").alias("months"))
    counted = by_loan.groupBy("year").agg(F.sum("months").alias("months"), F.count("*").alias("loans"))
    rows = counted.collect()  # one per vintage
    return {
        "origination": {int(r.year): r.loans for r in rows},
        "performance": {int(r.year): r.months for r in rows},
    }


def _texts(fields: list[str], texts: dict[str, str]) -> list[str]:
    return [f"{texts.get(name, repr(''))} AS {name}" for name in fields]


def raw_origination(spark: SparkSession, sf_dir: str, only_observed: bool = True) -> DataFrame:
    """All-text origination rows, one per customer.

    ``only_observed`` keeps the customers that occur in the panel. Joins with the
    panel do not need it and save a pass over it.
    """
    loans = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k")
    if only_observed:
        lines = _shipped_lines(spark, sf_dir, partitions(spark, sf_dir))
        loans = loans.join(lines.select("k").distinct(), "k", "left_semi")
    return loans.selectExpr(
        "k",
        f"{_YEAR} AS source_year",
        "'panel' AS source_file",
        *_texts(ORIGINATION_FIELDS, ORIGINATION_TEXT),
    )


def raw_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text performance rows, the panel rendered as the raw files hold it."""
    return performance(spark, sf_dir).selectExpr(
        "k", "mp", "source_year", "source_file", *_texts(PERFORMANCE_FIELDS, _PERFORMANCE_TEXT)
    )


def staged_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_performance(performance(spark, sf_dir))


def staged_origination(spark: SparkSession, sf_dir: str, only_observed: bool = True) -> DataFrame:
    return stage_origination(raw_origination(spark, sf_dir, only_observed))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan-month panel; the inner join itself drops unobserved customers."""
    dim = dim_loan(staged_origination(spark, sf_dir, only_observed=False))
    return fact_loan_month(staged_performance(spark, sf_dir), dim)
