"""The derived panel with planted failures, so that every check has something to find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.operators.curated import dim_loan, fact_loan_month, weighted_pairs
from loanscope.operators.marts import portfolio_by_segment, portfolio_monthly, transition_monthly
from loanscope.operators.quality import Layers
from loanscope.operators.staging import flag_performance, stage_origination
from loanscope.sources.storage import scratch_dir, written
from loanscope.testbed import panel

_k, _mp = "k", "mp"


def _hit(column: str, divisor: int, remainder: int) -> Column:
    return F.col(column) % divisor == remainder


def _replaced(rows: DataFrame, changes: dict[str, list[tuple[Column, Column]]]) -> DataFrame:
    """Replace columns where a condition holds; the first listed condition wins."""
    columns = {}
    for name, cases in changes.items():
        value = F.col(name)
        for condition, new in reversed(cases):
            value = F.when(condition, new).otherwise(value)
        columns[name] = value.cast(rows.schema[name].dataType)
    return rows.withColumns(columns)


def _doubled(rows: DataFrame, condition: Column) -> DataFrame:
    copies = F.when(condition, 2).otherwise(1)
    return rows.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")


def origination(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _replaced(
        panel.raw_origination(spark, sf_dir),
        {
            "classic_fico": [(_hit(_k, 70, 3), F.lit("900"))],
            "original_dti": [(_hit(_k, 75, 4), F.lit("80"))],
            "original_upb": [(_hit(_k, 80, 5), F.lit("0"))],
        },
    )
    return stage_origination(_doubled(raw.filter(~_hit(_k, 50, 7)), _hit(_k, 90, 6)))


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.col("as_of_month")
    nothing = F.lit(None)
    typed = _replaced(
        panel.performance(spark, sf_dir).withColumn("shown_month", month),
        {
            "shown_month": [
                (_hit(_mp, 501, 1), F.add_months(month, -120)),
                (_hit(_mp, 503, 2), F.add_months(month, 120)),
            ],
            "delinquency_status_raw": [
                (_hit(_mp, 401, 3), F.lit("A1")),
                (_hit(_mp, 403, 4), nothing),
            ],
            "delinquency_months": [(_hit(_mp, 401, 3) | _hit(_mp, 403, 4), nothing)],
            "zero_balance_code": [
                (_hit(_mp, 307, 5), F.lit("77")),
                (_hit(_mp, 311, 6), F.lit("01")),
            ],
            "zero_balance_effective_month": [
                (_hit(_mp, 307, 5), month),
                (_hit(_mp, 311, 6), nothing),
            ],
            "current_actual_upb": [
                (_hit(_mp, 313, 7), F.lit(-100)),
                (_hit(_mp, 317, 8), nothing),
            ],
        },
    ).drop("as_of_month").withColumnRenamed("shown_month", "as_of_month")
    rows = flag_performance(_doubled(typed.filter(~_hit(_k, 60, 11)), _hit(_mp, 347, 11)))
    return _replaced(
        rows,
        {
            "is_on_book_eom": [(_hit(_mp, 331, 9), ~F.col("is_on_book_eom"))],
            "is_delinquency_eligible": [(_hit(_mp, 337, 10), F.lit(True))],
        },
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_loan_month(performance(spark, sf_dir), dim_loan(origination(spark, sf_dir)))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted pairs of the panel, in tasks whose size does not depend on the tables."""
    return weighted_pairs(fact(spark, sf_dir), panel.partitions(spark, sf_dir))


def monthly(rows: DataFrame) -> DataFrame:
    raised = F.col("as_of_month") == F.lit("2020-06-01").cast("date")
    return _replaced(
        portfolio_monthly(rows),
        {
            "dq30_loan_count": [(raised, F.col("dq30_loan_count") + 1_000_000)],
            "dq90_upb": [
                (
                    F.col("as_of_month") == F.lit("2021-06-01").cast("date"),
                    F.col("dq90_upb") + 1_000_000_000_000,
                )
            ],
        },
    )


def _segments(rows: DataFrame) -> DataFrame:
    return portfolio_by_segment(rows).filter(
        ~(
            (F.col("as_of_month") == F.lit("2022-03-01").cast("date"))
            & (F.col("segment_name") == "original_dti")
        )
    )


def _transitions(pairs: DataFrame) -> DataFrame:
    from_month = F.col("from_month")
    return _replaced(
        transition_monthly(pairs),
        {
            "transition_loan_count": [
                (
                    (from_month == F.lit("2020-03-01").cast("date"))
                    & (F.col("to_state") == "CURRENT"),
                    F.col("transition_loan_count") + 5,
                )
            ],
            "transition_count_rate": [
                (
                    (from_month == F.lit("2021-01-01").cast("date")) & (F.col("to_state") == "30"),
                    F.col("transition_count_rate") + 0.5,
                )
            ],
        },
    )


def _tampered(pairs: DataFrame) -> DataFrame:
    return _replaced(
        pairs,
        {
            "to_month": [
                (
                    F.col("loan_id").endswith("13")
                    & (F.col("from_month") == F.lit("2020-05-01").cast("date")),
                    F.add_months("to_month", 1),
                )
            ],
            "from_upb": [(F.col("loan_id").endswith("17"), F.lit(0))],
        },
    )


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """All tables, each derived and stored once, as a build does; many checks read each."""
    folder = scratch_dir(spark, "dirty")

    def stored(name: str, table: DataFrame) -> DataFrame:
        return written(table, f"{folder}/{name}")

    loans = stored("origination", origination(spark, sf_dir))
    months = stored("performance", performance(spark, sf_dir).drop(_k, _mp))
    parts = panel.partitions(spark, sf_dir)
    panel_rows = fact_loan_month(panel.spread(months, parts, "loan_id"), dim_loan(loans))
    rows = stored("fact", panel_rows)
    # Pairs hold a row for each loan-month in memory: partitions of the join, which follow the
    # amount of data, suit them better than splits of the stored table.
    pairs = stored("pairs", weighted_pairs(panel_rows, parts))
    return Layers(
        origination=loans,
        performance=months,
        fact=rows,
        pairs=_tampered(pairs),
        monthly=stored("monthly", monthly(rows)),
        segments=stored("segments", _segments(rows)),
        transitions=stored("transitions", _transitions(pairs)),
    )
