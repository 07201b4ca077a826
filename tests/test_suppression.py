import random
from collections import defaultdict

import pytest

from loanscope.domain import OTHER_DESTINATION, OTHER_SEGMENT
from loanscope.operators.marts import CORE_MEASURES
from loanscope.operators.suppression import suppress_segments, suppress_transitions
from tests.helpers import day

K = 10


def segments(spark, cells):
    """Mart rows from (month, dimension, value, loans)."""
    schema = "as_of_month string, segment_name string, segment_value string, " + ", ".join(
        f"{m} {'decimal(38,2)' if m.endswith('upb') else 'bigint'}" for m in CORE_MEASURES
    )
    from decimal import Decimal

    rows = [
        (m, d, v, *(Decimal(n) if c.endswith("upb") else n for c in CORE_MEASURES)) for m, d, v, n in cells
    ]
    return spark.createDataFrame(rows, schema).selectExpr("date(as_of_month) AS as_of_month", "* EXCEPT (as_of_month)")


def shown(spark, counts, strict=False):
    cells = [("2020-01-01", "classic_fico", v, n) for v, n in counts.items()]
    result = suppress_segments(segments(spark, cells), K, strict).collect()
    return {r.segment_value: r.on_book_loan_count for r in result}


@pytest.mark.parametrize(
    "counts, expected",
    [
        ({"a": 10, "b": 11}, {"a": 10, "b": 11}),
        ({"a": 9, "b": 20, "c": 15}, {OTHER_SEGMENT: 24, "b": 20}),
        ({"a": 5, "b": 4, "c": 15, "d": 30}, {OTHER_SEGMENT: 24, "d": 30}),
        ({"a": 5, "b": 5, "c": 15}, {OTHER_SEGMENT: 10, "c": 15}),
        ({"a": 3, "c": 15, "b": 15}, {OTHER_SEGMENT: 18, "c": 15}),
        ({"a": 3, "b": 4}, {OTHER_SEGMENT: 7}),
        ({"a": 0, "b": 15}, {OTHER_SEGMENT: 0, "b": 15}),
    ],
)
def test_segment_rule(spark, counts, expected):
    assert shown(spark, counts) == expected


def test_strict_drops_buckets_below_the_threshold(spark):
    assert shown(spark, {"a": 3, "b": 4}, strict=True) == {}
    assert shown(spark, {"a": 0, "b": 15}, strict=True) == {"b": 15}


def test_threshold_must_be_at_least_two(spark):
    with pytest.raises(ValueError):
        suppress_segments(segments(spark, [("2020-01-01", "classic_fico", "a", 1)]), 1)


def test_sort_order(spark):
    cells = [
        ("2020-01-01", "origination_year", "2019", 50),
        ("2020-01-01", "origination_year", "2020", 3),
        ("2020-01-01", "origination_year", "2021", 8),
        ("2020-01-01", "classic_fico", "780+", 50),
        ("2020-01-01", "classic_fico", "<620", 30),
        ("2020-01-01", "classic_fico", "Unknown", 1),
        ("2020-01-01", "classic_fico", "620-659", 9),
    ]
    rows = suppress_segments(segments(spark, cells), K).collect()
    assert {(r.segment_name, r.segment_value): r.segment_sort_order for r in rows} == {
        ("origination_year", "2019"): 2019,
        ("origination_year", OTHER_SEGMENT): None,
        ("classic_fico", "780+"): 6,
        ("classic_fico", "<620"): 1,
        ("classic_fico", OTHER_SEGMENT): 99,
    }


def brute_force(counts):
    """The rule by enumeration, for one group."""
    low = {v for v, n in counts.items() if n < K}
    total = sum(counts[v] for v in low)
    merged = set(low)
    safe = sorted((n, v) for v, n in counts.items() if n >= K)
    if 1 <= total < K and safe:
        merged.add(safe[0][1])
    result = {v: n for v, n in counts.items() if v not in merged}
    if merged:
        result[OTHER_SEGMENT] = sum(counts[v] for v in merged)
    return result


def test_random_groups_against_brute_force(spark):
    chance = random.Random(11)
    groups = {
        f"20{y:02d}-{m:02d}-01": {chr(97 + i): chance.choice([0, 1, 2, 4, 9, 10, 10, 12, 40]) for i in range(chance.randint(1, 6))}
        for y in range(10, 20)
        for m in range(1, 13)
    }
    cells = [(month, "d", v, n) for month, counts in groups.items() for v, n in counts.items()]
    got = defaultdict(dict)
    for r in suppress_segments(segments(spark, cells), K).collect():
        got[str(r.as_of_month)][r.segment_value] = r.on_book_loan_count
    assert got == {month: brute_force(counts) for month, counts in groups.items()}


def test_transition_cohorts_and_destinations(spark):
    flows = {
        ("CURRENT", "CURRENT"): 50, ("CURRENT", "30"): 12, ("CURRENT", "60"): 3,
        ("30", "CURRENT"): 5, ("30", "60"): 5,
        ("60", "90+"): 9,
    }
    rows = [("2020-01-01", "2020-02-01", "all", "All", f, t, n) for (f, t), n in flows.items()]
    rows.append(("2020-01-01", "2020-02-01", "origination_year", "2019", "CURRENT", "30", 99))
    mart = spark.createDataFrame(
        rows, "a string, b string, segment_name string, segment_value string, from_state string, to_state string, n bigint"
    ).selectExpr(
        "date(a) AS from_month", "date(b) AS to_month", "segment_name", "segment_value", "from_state", "to_state",
        "n AS transition_loan_count", "cast(n AS decimal(38,2)) AS transition_from_upb",
    )
    result = suppress_transitions(mart, K).collect()
    assert {(r.from_state, r.to_state): r.transition_loan_count for r in result} == {
        ("CURRENT", "CURRENT"): 50,
        ("CURRENT", OTHER_DESTINATION): 15,
        ("30", OTHER_DESTINATION): 10,
    }
    assert {r.observable_from_state_loan_count for r in result if r.from_state == "CURRENT"} == {65}
    assert sum(r.transition_count_rate for r in result if r.from_state == "CURRENT") == pytest.approx(1)
    assert {(r.to_state, r.to_state_sort_order) for r in result} >= {(OTHER_DESTINATION, 99), ("CURRENT", 1)}
    assert {r.from_month for r in result} == {day("2020-01-01")}
