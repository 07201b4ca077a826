"""Checks of the export tables before they are handed out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.functions.measures import total
from loanscope.operators.exports import identifier_columns
from loanscope.operators.quality import (
    key_failures,
    measures_differ,
    reported,
    row_count,
    segment_rollup,
)

SEGMENT_KEY = ["as_of_month", "segment_name", "segment_value"]
TRANSITION_KEY = ["from_month", "from_state", "to_state"]

# Fixed check names, in report order.
DETAILS = {
    "portfolio row count": "The monthly export has as many rows as the mart.",
    "segment key uniqueness": "Month, dimension and value identify a segment row.",
    "segment totals": "Exported segments add up to the exported months.",
    "transition key uniqueness": "Month and both states identify a transition row.",
    "transition cohort totals": "Every cohort of at least k loans is exported in full.",
    "loan identifier columns": "Exports hold no loan identifier.",
}


def row_count_gap(export: DataFrame, mart: DataFrame) -> DataFrame:
    """Absolute difference of two row counts, as one result row."""
    signed = export.select(F.lit(1).alias("n")).unionAll(mart.select(F.lit(-1).alias("n")))
    return signed.agg(F.abs(F.coalesce(F.sum("n"), F.lit(0))).alias("failed_row_count")).select(
        F.lit("portfolio row count").alias("check_name"), "failed_row_count"
    )


def repeated_keys(export: DataFrame, key: list[str]) -> DataFrame:
    return key_failures(export, key).filter("n > 1")


def cohort_gaps(export: DataFrame, mart: DataFrame, k: int) -> DataFrame:
    """Cohorts of at least k loans that the export lacks, adds or changes."""

    def cohorts(flows: DataFrame, prefix: str) -> DataFrame:
        return flows.groupBy("from_month", "from_state").agg(
            F.sum("transition_loan_count").alias(f"{prefix}_loans"),
            total(F.col("transition_from_upb")).alias(f"{prefix}_upb"),
        )

    due = cohorts(mart.filter("segment_name = 'all'"), "due").filter(F.col("due_loans") >= k)
    shown = cohorts(export, "shown")
    return due.join(shown, ["from_month", "from_state"], "full").filter(
        ~F.col("due_loans").eqNullSafe(F.col("shown_loans"))
        | ~F.col("due_upb").eqNullSafe(F.col("shown_upb"))
    )


def identifier_check(*exports: DataFrame) -> DataFrame:
    """Number of identifier columns over all exports, as one result row."""
    found = sum(len(identifier_columns(export)) for export in exports)
    return exports[0].sparkSession.sql(
        f"SELECT 'loan identifier columns' AS check_name, bigint({found}) AS failed_row_count"
    )


def export_results(
    monthly: DataFrame,
    segments: DataFrame,
    transitions: DataFrame,
    monthly_mart: DataFrame,
    transition_mart: DataFrame,
    k: int,
) -> DataFrame:
    """Check report over the three exports and the marts they come from."""
    counts = [
        row_count_gap(monthly, monthly_mart),
        row_count(repeated_keys(segments, SEGMENT_KEY), "segment key uniqueness"),
        row_count(measures_differ(segment_rollup(segments), monthly), "segment totals"),
        row_count(repeated_keys(transitions, TRANSITION_KEY), "transition key uniqueness"),
        row_count(cohort_gaps(transitions, transition_mart, k), "transition cohort totals"),
        identifier_check(monthly, segments, transitions),
    ]
    return reported(reduce(DataFrame.unionByName, counts), DETAILS)


def stored_gaps(
    computed: dict[str, DataFrame], stored: dict[str, DataFrame], fields: dict[str, list[str]]
) -> DataFrame:
    """Check report: rows of each table that its stored copy lacks, adds or changes.

    Rows count as often as they stand, in the fields that a dashboard reads. Empty text and
    NULL are the same in a CSV file.
    """

    def signed(table: DataFrame, names: list[str], sign: int) -> DataFrame:
        kinds = dict(table.dtypes)
        read = (F.expr(f"nullif({n}, '')") if kinds[n] == "string" else F.col(n) for n in names)
        return table.select(*(c.alias(n) for c, n in zip(read, names)), F.lit(sign).alias("sign"))

    counts, details = [], {}
    for name, table in computed.items():
        both = signed(table, fields[name], 1).unionByName(signed(stored[name], fields[name], -1))
        differing = both.groupBy(*fields[name]).agg(F.sum("sign").alias("n")).filter("n <> 0")
        check = f"{name} stored"
        details[check] = f"The stored {name} table has the rows that were computed."
        counts.append(row_count(differing, check))
    return reported(reduce(DataFrame.unionByName, counts), details)


def dashboard_input_problems(
    monthly: DataFrame,
    segments: DataFrame,
    transitions: DataFrame,
    month_count: int,
    first_month: str,
    last_month: str,
) -> DataFrame:
    """Check report on the tables a dashboard is about to show.

    Each must be non-empty, have unique keys and no identifier, and the monthly
    table must span the expected window.
    """
    details = {}
    counts = []
    keyed = {
        "monthly": (monthly, ["as_of_month"]),
        "segments": (segments, SEGMENT_KEY),
        "transitions": (transitions, TRANSITION_KEY),
    }
    for name, (table, key) in keyed.items():
        empty, repeated, disclosed = (
            f"{name} not empty", f"{name} key uniqueness", f"{name} identifier columns",
        )
        details[empty] = f"The {name} table has rows."
        details[repeated] = f"Keys of the {name} table are unique."
        details[disclosed] = f"The {name} table holds no loan identifier."
        rows = table.agg(F.count("*").alias("rows"))
        counts.append(
            rows.select(
                F.lit(empty).alias("check_name"),
                (F.col("rows") == 0).cast("bigint").alias("failed_row_count"),
            )
        )
        counts.append(row_count(repeated_keys(table, key), repeated))
        counts.append(
            rows.select(
                F.lit(disclosed).alias("check_name"),
                F.lit(len(identifier_columns(table))).cast("bigint").alias("failed_row_count"),
            )
        )
    window = monthly.agg(
        F.count("*").alias("months"),
        F.min("as_of_month").cast("date").alias("first"),
        F.max("as_of_month").cast("date").alias("last"),
    )
    expectations = {
        "month count": F.col("months") == month_count,
        "first month": F.col("first").eqNullSafe(F.lit(first_month).cast("date")),
        "last month": F.col("last").eqNullSafe(F.lit(last_month).cast("date")),
    }
    for name, met in expectations.items():
        details[name] = f"The {name} is the expected one."
    results = F.array(
        *(
            F.struct(
                F.lit(name).alias("check_name"), (~met).cast("bigint").alias("failed_row_count")
            )
            for name, met in expectations.items()
        )
    )
    counts.append(window.select(F.inline(results)))
    return reported(reduce(DataFrame.unionByName, counts), details)
