"""Small hand-made tables."""

import datetime
import decimal

from pyspark.sql import functions as F

from loanscope.operators.curated import BAND_COLUMNS
from loanscope.operators.staging import flag_performance

TYPED = (
    "loan_id string, as_of_month string, current_actual_upb decimal(18,2), "
    "delinquency_status_raw string, loan_age smallint, zero_balance_code string"
)


def day(text):
    return datetime.date.fromisoformat(text)


def performance(spark, rows):
    """Flagged loan-months from (loan, month, upb, status, age, code) tuples."""
    rows = [(r[0], r[1], None if r[2] is None else decimal.Decimal(r[2]), *r[3:]) for r in rows]
    typed = (
        spark.createDataFrame(rows, TYPED)
        .withColumn("as_of_month", F.col("as_of_month").cast("date"))
        .withColumn(
            "delinquency_months",
            F.expr(r"if(delinquency_status_raw RLIKE '^[0-9]{2}$', smallint(delinquency_status_raw), NULL)"),
        )
        .withColumn("zero_balance_effective_month", F.expr("if(zero_balance_code IS NULL, NULL, as_of_month)"))
        .withColumn("source_year", F.lit(2019).cast("smallint"))
        .withColumn("source_file", F.lit("hand"))
    )
    return flag_performance(typed)


def fact(spark, rows, **bands):
    """The same with vintage and bands, without going through a dimension."""
    table = performance(spark, rows).withColumns(
        {
            "origination_year": F.lit(2019).cast("smallint"),
            "origination_quarter": F.lit("Q1"),
        }
    )
    return table.withColumns({b: F.lit(bands.get(b, "Unknown")) for b in BAND_COLUMNS})


def rows_of(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)
