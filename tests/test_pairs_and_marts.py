import random

from pyspark.sql import functions as F

from loanscope.operators import marts
from loanscope.operators.curated import (
    next_month_pairs,
    next_month_pairs_ordered,
    weighted_pairs,
)
from loanscope.operators.quality import population_identity_failures
from loanscope.testbed import dirty, panel
from tests.helpers import day, fact, rows_of

SF = "/root/testdata/sf0.001"

HAND = [
    ("a", "2019-11-01", "10", "00", 1, None),
    ("a", "2019-12-01", "11", "01", 2, None),
    ("a", "2020-01-01", "12", "02", 3, None),
    ("a", "2020-03-01", "13", "00", 5, None),
    ("a", "2020-04-01", "0", "00", 6, "01"),
    ("a", "2020-05-01", "9", "00", 7, None),
    ("b", "2020-04-01", "7", "00", 1, None),
    ("c", "2020-03-01", None, "00", 1, None),
    ("c", "2020-04-01", "7", "00", 2, None),
]


def test_pairs_are_exact_next_months(spark):
    pairs = next_month_pairs(fact(spark, HAND))
    got = {(r.loan_id, r.from_month, r.from_state, r.to_state) for r in pairs.collect()}
    assert got == {
        ("a", day("2019-11-01"), "CURRENT", "30"),
        ("a", day("2019-12-01"), "30", "60"),
        ("a", day("2020-03-01"), "CURRENT", "TERMINATED:01"),
    }
    assert rows_of(next_month_pairs_ordered(fact(spark, HAND))) == rows_of(pairs)


def test_repeated_keys_multiply_and_are_counted_not_expanded(spark):
    rows = fact(spark, HAND * 3 + [("a", "2019-12-01", "11", "00", 2, None)])
    plain, weighted = next_month_pairs(rows), weighted_pairs(rows)
    # 3 x 4 pairs into December, 4 x 3 out of it and 3 x 3 in spring.
    assert weighted.agg(F.sum("pair_count")).first()[0] == plain.count() == 12 + 12 + 9
    assert weighted.count() < plain.count()
    assert rows_of(marts.transition_monthly(weighted)) == rows_of(marts.transition_monthly(plain))
    # The one-pass form is only for unique keys: here it gives something else.
    assert next_month_pairs_ordered(rows).count() != plain.count()


def test_forms_agree_on_the_dirty_panel(spark):
    rows = dirty.fact(spark, SF)
    assert rows_of(marts.transition_monthly(weighted_pairs(rows))) == rows_of(
        marts.transition_monthly(next_month_pairs(rows))
    )
    assert rows_of(marts.portfolio_by_segment(rows)) == rows_of(
        marts.portfolio_by_segment_prereduced(rows)
    )


def test_month_without_on_book_loans(spark):
    row = marts.portfolio_monthly(fact(spark, [("a", "2020-04-01", "0", "00", 6, "01")])).first()
    assert (row.on_book_loan_count, row.on_book_upb, row.dq30_loan_count) == (0, 0, 0)
    assert (row.numeric_status_coverage_count_rate, row.dq90_balance_rate) == (None, None)


def test_monthly_measures_against_a_plain_loop(spark):
    chance = random.Random(5)
    rows = [
        (
            f"l{i}",
            f"2020-0{chance.randint(1, 3)}-01",
            chance.choice([None, "0", "10.25", "99.99", "-5"]),
            chance.choice(["00", "01", "02", "03", "17", "RA", "XX", None, "A1"]),
            chance.choice([None, -1, 0, 1, 9]),
            chance.choice([None, None, None, "01"]),
        )
        for i in range(400)
    ]
    table = fact(spark, rows)
    got = {str(r.as_of_month): r for r in marts.portfolio_monthly(table).collect()}
    for month in ("2020-01-01", "2020-02-01", "2020-03-01"):
        mine = [r for r in rows if r[1] == month]
        book = [r for r in mine if r[2] is not None and float(r[2]) > 0 and r[5] is None]
        numeric = [r for r in book if r[3] and r[3].isdigit()]
        eligible = [r for r in numeric if r[4] is not None and r[4] >= 1]
        row = got[month]
        assert row.on_book_loan_count == len(book)
        assert row.delinquency_eligible_loan_count == len(eligible)
        assert row.excluded_pre_due_loan_count == sum(r[4] == 0 and int(r[3]) == 0 for r in numeric)
        assert row.excluded_loan_age_zero_loan_count == sum(r[4] == 0 for r in book)
        assert row.excluded_invalid_loan_age_loan_count == sum(r[4] in (None, -1) for r in book)
        for days, months in ((30, 1), (60, 2), (90, 3)):
            late = [r for r in eligible if int(r[3]) >= months]
            assert row[f"dq{days}_loan_count"] == len(late)
            assert float(row[f"dq{days}_upb"]) == round(sum(float(r[2]) for r in late), 2)
    assert population_identity_failures(marts.portfolio_monthly(table)).isEmpty()


def test_population_identity_holds_on_the_panel(spark):
    assert population_identity_failures(marts.portfolio_monthly(panel.fact(spark, SF))).isEmpty()
