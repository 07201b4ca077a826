"""Loan dimension, loan-month panel and exact next-month pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.domain import CLTV_BANDS, DTI_BANDS, FICO_BANDS, UNKNOWN_BAND
from loanscope.functions.measures import banded

BAND_COLUMNS = ["fico_band", "cltv_band", "dti_band"]
VINTAGE_COLUMNS = ["origination_year", "origination_quarter"]


def dim_loan(origination: DataFrame) -> DataFrame:
    """One narrow row per staged origination row, with the three risk bands."""
    bands = {
        "fico_band": banded("classic_fico", FICO_BANDS, UNKNOWN_BAND),
        "cltv_band": banded("original_cltv", CLTV_BANDS, UNKNOWN_BAND),
        "dti_band": banded("original_dti", DTI_BANDS, UNKNOWN_BAND),
    }
    columns = [
        "loan_id",
        *VINTAGE_COLUMNS,
        "first_payment_month",
        "maturity_month",
        "classic_fico",
        "fico_band",
        "original_cltv",
        "cltv_band",
        "original_ltv",
        "original_dti",
        "dti_band",
        "original_upb",
        "original_interest_rate",
        "original_loan_term",
        "property_state",
        "property_type",
        "occupancy_status",
        "loan_purpose",
        "channel",
        "source_year",
        "source_file",
    ]
    return origination.selectExpr(
        *(f"{bands[name]} AS {name}" if name in bands else name for name in columns)
    )


def fact_loan_month(performance: DataFrame, dim: DataFrame) -> DataFrame:
    """Performance rows of known loans with the loan's vintage and bands.

    No broadcast hint: the dimension grows with the number of loans, so the
    optimizer picks the join from measured sizes, and adaptive execution
    splits a skewed loan.
    """
    attributes = dim.select("loan_id", *VINTAGE_COLUMNS, *BAND_COLUMNS)
    return performance.join(attributes, "loan_id").select(
        "loan_id",
        "as_of_month",
        *VINTAGE_COLUMNS,
        *BAND_COLUMNS,
        "current_actual_upb",
        "delinquency_status_raw",
        "delinquency_months",
        "loan_age",
        "zero_balance_code",
        "zero_balance_effective_month",
        "is_terminal_record",
        "is_on_book_eom",
        "is_numeric_delinquency_status",
        "is_delinquency_eligible",
        "monitoring_state",
        "source_year",
        "source_file",
    )


_SOURCE = ["origination_year", *BAND_COLUMNS]
PAIR_COLUMNS = [
    "loan_id", "from_month", "to_month", *_SOURCE, "from_state", "to_state", "from_upb",
]


def _origins(fact: DataFrame) -> DataFrame:
    return fact.filter("is_on_book_eom").select(
        "loan_id",
        F.col("as_of_month").alias("from_month"),
        F.add_months("as_of_month", 1).alias("to_month"),
        *_SOURCE,
        F.col("monitoring_state").alias("from_state"),
        F.col("current_actual_upb").alias("from_upb"),
    )


def _destinations(fact: DataFrame) -> DataFrame:
    return fact.select(
        "loan_id",
        F.col("as_of_month").alias("to_month"),
        F.col("monitoring_state").alias("to_state"),
    )


def next_month_pairs(fact: DataFrame) -> DataFrame:
    """Each on-book loan-month paired with the same loan's next calendar month.

    The defining self-join: exact for any input, also when loan-months repeat
    (every origin then meets every destination). A last observation, or one
    before a gap, has no pair.
    """
    pairs = _origins(fact).join(_destinations(fact), ["loan_id", "to_month"])
    return pairs.select(*PAIR_COLUMNS)


def next_month_pairs_ordered(fact: DataFrame) -> DataFrame:
    """The same pairs for a panel whose (loan_id, as_of_month) is known unique.

    One pass over the panel and one exchange by loan instead of a self-join; no
    exchange at all on a panel stored clustered by loan. With a unique key one
    loan has at most one row per calendar month, so the window groups stay
    small. Use :func:`next_month_pairs` or :func:`weighted_pairs` otherwise.
    """
    by_loan = Window.partitionBy("loan_id").orderBy("as_of_month")
    following = fact.filter(F.col("loan_id").isNotNull()).select(
        "loan_id",
        F.col("as_of_month").alias("from_month"),
        F.lead("as_of_month").over(by_loan).alias("to_month"),
        *_SOURCE,
        F.col("monitoring_state").alias("from_state"),
        F.lead("monitoring_state").over(by_loan).alias("to_state"),
        F.col("current_actual_upb").alias("from_upb"),
        "is_on_book_eom",
    )
    # The on-book test must follow the window: an off-book row is still a destination.
    adjacent = F.col("to_month") == F.add_months("from_month", 1)
    return following.filter(F.col("is_on_book_eom") & adjacent).select(*PAIR_COLUMNS)


def weighted_pairs(fact: DataFrame, partitions: int | None = None) -> DataFrame:
    """The pairs of :func:`next_month_pairs` as distinct rows with ``pair_count``.

    Repeated loan-months are counted before the join rather than multiplied by
    it, so a key that repeats n times costs n partial counts, not n x n rows,
    and no task ever sees the repeats. Totals taken with the weight equal
    totals over the plain pairs.
    """
    origins = _origins(fact)
    origins = origins.groupBy(*origins.columns).agg(F.count("*").alias("origin_count"))
    destinations = _destinations(fact)
    destinations = destinations.groupBy(*destinations.columns).agg(
        F.count("*").alias("destination_count")
    )
    key = ["loan_id", "to_month"]
    if partitions is not None:
        origins, destinations = (
            side.repartition(partitions, *key) for side in (origins, destinations)
        )
    return origins.join(destinations, key).select(
        *PAIR_COLUMNS,
        (F.col("origin_count") * F.col("destination_count")).alias("pair_count"),
    )
