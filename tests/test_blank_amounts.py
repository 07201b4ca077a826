"""Blank amounts never reach a cast to decimal, where text that is no number costs an exception."""

import pytest
from pyspark.sql import functions as F

from loanscope.functions.parsing import MONEY, number, whole
from loanscope.testbed import panel


def plan(table):
    return table._jdf.queryExecution().optimizedPlan().toString() + table._jdf.queryExecution().executedPlan().toString()


def test_amounts_are_read_as_before_and_blanks_are_not_cast(spark):
    rows = spark.createDataFrame([("",), ("  ",), ("12.345",), ("x",), (None,), ("-7",)], "t string")
    found = rows.selectExpr(f"string({number('t', MONEY)}) AS n", f"{whole('t')} AS w").collect()
    assert [tuple(r) for r in found] == [(None, None), (None, None), ("12.35", 12), (None, None), (None, None), ("-7.00", -7)]
    # What is cast, where a failing cast raises.
    for expression in (number("t", MONEY), whole("t")):
        strict = rows.filter("t = ''").selectExpr(expression.replace("try_cast(nullif(t, '')", "cast(nullif(t, '')"))
        assert "cast(nullif" in expression and strict.collect()[0][0] is None


@pytest.mark.parametrize("k", [0, 42, 9_999_999, 10_000_000, 123_456_789, -5])
def test_loan_ids_are_padded_to_seven_digits(spark, k):
    found = spark.range(1).select(F.lit(k).cast("long").alias("k")).selectExpr(panel._LOAN_ID).first()[0]
    assert found.endswith("%07d" % k) and found.startswith("F")
