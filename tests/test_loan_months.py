import datetime
import random
from collections import Counter

from loanscope.operators.loan_months import (
    loan_months,
    month_summary,
    repeated_loan_months,
    unclear_loans,
    word_count,
)
from loanscope.operators.quality import missing_pairs
from loanscope.sources.storage import scratch_dir, written


def month(number):
    return None if number is None else datetime.date(2019 + number // 12, number % 12 + 1, 1)


def stored(spark, reduced):
    return written(reduced, f"{scratch_dir(spark, 'test')}/months")


def test_bitmaps_against_sets(spark):
    draw = random.Random(1)
    rows = []
    for loan in [*(f"L{i}" for i in range(60)), None]:
        months = sorted(draw.sample(range(150), draw.randint(1, 120)))
        rows += [(loan, month(m), draw.random() < 0.8) for m in months]
    rows += [("L0", month(63), True), ("L0", month(64), True), ("L1", month(127), True), ("L1", month(128), False)]
    rows += [("L2", None, True), ("L3", datetime.date(1999, 1, 1), True), ("L4", datetime.date(2035, 7, 1), True)]
    rows += [("L5", datetime.date(2019, 3, 2), True), ("L6", month(5), True)] * 2 + [("hot", month(7), True)] * 500
    frame = spark.createDataFrame(rows, "loan_id string, as_of_month date, is_on_book_eom boolean").repartition(5)
    for words in (1, 3):
        reduced = stored(spark, loan_months(frame, words))
        found = {r.loan_id: r for r in month_summary(reduced).collect()}
        inside = {month(m) for m in range(64 * words)}
        for loan in {r[0] for r in rows}:
            own = {r[1] for r in rows if r[0] == loan} & inside
            on_book = {r[1] for r in rows if r[0] == loan and r[2]} & inside
            after = {m: (m.replace(day=28) + datetime.timedelta(days=5)).replace(day=1) for m in on_book}
            want = (sum(r[0] == loan for r in rows), len(own), sum(after[m] in own for m in on_book))
            assert tuple(found[loan])[1:] == want
        keys = Counter(r[:2] for r in rows)
        want = {(*k, n) for k, n in keys.items() if n > 1 or None in k}
        assert {tuple(r) for r in repeated_loan_months(frame, reduced).collect()} == want


def test_clear_loans_read_no_rows(spark):
    rows = [(f"L{i}", month(m), True) for i in range(5) for m in range(87)]
    frame = spark.createDataFrame(rows, "loan_id string, as_of_month date, is_on_book_eom boolean")
    reduced = stored(spark, loan_months(frame, word_count(2019, "2026-03-01")))
    assert word_count(2019, "2026-03-01") == 2 and unclear_loans(reduced).isEmpty()
    assert repeated_loan_months(frame, reduced).collect() == []
    nothing = loan_months(frame.limit(0), 1)
    assert nothing.collect() == [] and repeated_loan_months(frame, nothing).collect() == []
    flows = spark.createDataFrame([(400,), (30,)], "transition_loan_count long")
    assert missing_pairs(reduced, flows).first().failed_row_count == 0
    assert missing_pairs(reduced, flows.limit(1)).first().failed_row_count in (30, 400)
    assert missing_pairs(nothing, flows.limit(0)).first().failed_row_count == 0
