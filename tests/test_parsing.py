import pytest
from pyspark.sql import functions as F

from loanscope.functions import parsing
from tests.helpers import day


def evaluate(spark, expression, values):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in table.select("i", F.expr(expression).alias("y")).orderBy("i").collect()]


def test_month_needs_six_digits(spark):
    values = ["201901", "202012", "201913", "201900", "20191", "2019011", "2019 1", "000001", "201901\n", "", None]
    got = evaluate(spark, parsing.month("x"), values)
    assert got[:2] == [day("2019-01-01"), day("2020-12-01")]
    assert got[2:] == [None] * 9


def test_whole_numbers(spark):
    values = ["12", " 12 ", "+5", "0012", "-3", "12.5", "-1.5", "1e2", "99999", "abc", "", None]
    assert evaluate(spark, parsing.whole("x"), values) == [
        12, 12, 5, 12, -3, 13, -2, 100, None, None, None, None,
    ]


def test_sentinels_are_per_field_and_exact(spark):
    values = ["9999", "0999", "999", "700", "", None, "junk"]
    assert evaluate(spark, parsing.whole_unless("x", "9999"), values) == [None, 999, 999, 700, None, None, None]
    assert evaluate(spark, parsing.whole_unless("x", "999"), values) == [9999, 999, None, 700, None, None, None]
    assert evaluate(spark, parsing.missing_reason("x", "9999"), values) == [
        "NOT_AVAILABLE", None, None, None, "BLANK", "BLANK", None,
    ]


def test_two_digit_status(spark):
    values = ["00", "07", "99", "1", "100", "RA", "01\n", " 1", "", None]
    assert evaluate(spark, parsing.two_digit_number("x"), values) == [0, 7, 99] + [None] * 7


@pytest.mark.parametrize(
    "value, expected", [("123.455", "123.46"), ("1e3", "1000.00"), (" 1 ", "1.00"), (".5", "0.50"), ("1,000", None), ("", None)]
)
def test_money(spark, value, expected):
    got = evaluate(spark, parsing.number("x", parsing.MONEY), [value])[0]
    assert (None if got is None else str(got)) == expected


def test_predicates_are_never_null(spark):
    assert evaluate(spark, parsing.is_number("x"), ["1", "1.5e3", "", None, "x", "nan"]) == [True, True, False, False, False, True]
    assert evaluate(spark, parsing.is_valid_month("x"), ["201901", "", None]) == [True, False, False]
