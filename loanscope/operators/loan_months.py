"""Which months each loan was observed in, as one row of bitmaps per loan.

Key, coverage and adjacency checks need no more than this. The bitmaps are built by bitwise-or
in the map tasks, so an exchange carries loans and not loan-months: 87 months of a loan are two
words and a count.

* More rows than bits: some month repeats, has no date, or lies outside the range of the
  bitmap. Only such loans are looked at row by row.
* A bitmap and itself shifted by one month have the loan's pairs of adjacent months in common.
* The rows are the loans that were observed at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.domain import VINTAGES

WORD = 64


def word_count(first_year: int, last_month: str) -> int:
    """Words for the months from January of a year to a last month (yyyy-mm-dd)."""
    year, month = int(last_month[:4]), int(last_month[5:7])
    return max(1, -(-((year - first_year) * 12 + month) // WORD))


def _or(values: Column, number: int) -> Column:
    """Bitwise or of the bits of one word."""
    place = F.col("month_number")
    here = F.floor(place / WORD) == number
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(WORD)).cast("int"))
    return F.coalesce(F.bit_or(F.when(values & here, bit)), F.lit(0).cast("long"))


def loan_months(performance: DataFrame, words: int, first_year: int = min(VINTAGES)) -> DataFrame:
    """``loan_id, row_count, observed, on_book``, one row per loan (one for missing ids too).

    ``observed`` and ``on_book`` are arrays of ``words`` 64-bit words, lowest month first, from
    January of ``first_year``; rows without month or outside the range set no bit.
    """
    month = F.col("as_of_month")
    number = (F.year(month) - first_year) * 12 + F.month(month) - 1
    # The first day of a month stands for it; another day is a key of its own.
    inside = (F.dayofmonth(month) == 1) & (number >= 0) & (number < words * WORD)
    rows = performance.select("loan_id", "is_on_book_eom", F.when(inside, number).alias("month_number"))
    seen = F.col("month_number").isNotNull()
    sets = {"observed": seen, "on_book": seen & F.col("is_on_book_eom")}
    parts = {f"{name}_{i}": _or(rule, i) for name, rule in sets.items() for i in range(words)}
    reduced = rows.groupBy("loan_id").agg(
        F.count("*").alias("row_count"), *(column.alias(name) for name, column in parts.items())
    )
    arrays = (F.array(*(f"{name}_{i}" for i in range(words))).alias(name) for name in sets)
    return reduced.select("loan_id", "row_count", *arrays)


def _bits(bitmap: Column) -> Column:
    return F.aggregate(bitmap, F.lit(0), lambda n, word: n + F.bit_count(word))


def month_count(bitmap: str = "observed") -> Column:
    return _bits(F.col(bitmap))


def adjacent_count(origin: str = "on_book", destination: str = "observed") -> Column:
    """Months of the origin bitmap whose next calendar month is in the destination bitmap."""
    bits = F.col(destination)
    carried = F.concat(F.slice(bits, 2, F.size(bits) - 1), F.array(F.lit(0).cast("long")))
    following = F.zip_with(
        bits, carried, lambda word, later: F.shiftrightunsigned(word, 1).bitwiseOR(F.shiftleft(later, 63))
    )
    return _bits(F.zip_with(F.col(origin), following, lambda a, b: a.bitwiseAND(b)))


def unclear_loans(reduced: DataFrame) -> DataFrame:
    """Loans whose rows are not each a month of their own, as far as bitmaps tell."""
    return reduced.filter(F.col("loan_id").isNull() | (F.col("row_count") != month_count()))


def repeated_loan_months(performance: DataFrame, reduced: DataFrame) -> DataFrame:
    """Loan-month keys that are incomplete or repeat: ``loan_id, as_of_month, n``.

    Only the rows of unclear loans are grouped by month, and none are read if there is none.
    ``reduced`` should be stored, as it is read twice.
    """
    unclear = unclear_loans(reduced).select(F.col("loan_id").alias("unclear_id"))
    rows = performance.select("loan_id", "as_of_month")
    if unclear.isEmpty():
        rows = rows.limit(0)
    rows = rows.join(unclear, F.col("loan_id").eqNullSafe(F.col("unclear_id")), "left_semi")
    incomplete = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in rows.columns))
    return rows.groupBy("loan_id", "as_of_month").agg(F.count("*").alias("n")).filter(incomplete | (F.col("n") > 1))


def month_summary(reduced: DataFrame) -> DataFrame:
    """``loan_id, row_count, months, adjacent_pairs`` of each loan."""
    return reduced.select(
        "loan_id", "row_count", month_count().cast("bigint").alias("months"),
        adjacent_count().cast("bigint").alias("adjacent_pairs"),
    )
