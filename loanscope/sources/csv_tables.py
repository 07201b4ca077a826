"""CSV hand-over of aggregate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.operators.exports import identifier_columns

_DATES = {"as_of_month", "from_month", "to_month"}


def write_csv(table: DataFrame, path: str) -> None:
    """Write a table as a folder of CSV parts with header; NULL is empty.

    Rows keep their order over the parts, and adaptive execution merges the
    parts of a small table into one file. Loan identifiers are refused.
    """
    disclosed = identifier_columns(table)
    if disclosed:
        raise ValueError(f"refusing to export loan identifiers: {disclosed}")
    (
        table.write.option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _required(field: str, type_name: str) -> Column:
    """A value of a type; text that is not raises, whatever the session says about casts."""
    value = F.col(field)
    problem = F.concat(F.lit(f"{field} is no {type_name}: "), value)
    read = F.coalesce(value.try_cast(type_name), F.raise_error(problem).cast(type_name))
    return F.when(value.isNotNull(), read)


def _typed(field: str) -> Column:
    if field in _DATES:
        return _required(field, "date")
    if field.endswith(("_loan_count", "_row_count")):
        return _required(field, "bigint")
    if field.endswith("_sort_order"):
        return _required(field, "int")
    if field.endswith("_upb"):
        return _required(field, "double")
    if field == "privacy_merged":
        return F.lower(F.col(field)) == "true"
    return F.col(field)


def read_csv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Chosen fields of an exported table, typed by name; text that is not of its
    field's type raises, and an empty value is NULL."""
    # Without a schema every column is text and named by the header.
    table = spark.read.option("header", True).option("nullValue", "").csv(path)
    missing = [field for field in fields if field not in table.columns]
    if missing:
        raise ValueError(f"Missing columns in {path}: {missing}")
    return table.select(*(_typed(field).alias(field) for field in fields))
