"""Bounds on hidden cells against all counts that the rule could have merged."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from loanscope.operators.disclosure import BOUNDS, SHOWN, TOTAL, disclosures, hidden_cells
from loanscope.operators.suppression import mark_merged


def exported(spark, groups, k):
    """An export of cells by group, with the rule of the library."""
    rows = [(g, f"c{i}", n) for g, cells in groups.items() for i, n in enumerate(cells)]
    mart = spark.createDataFrame(rows, "g int, label string, n long")
    marked = mark_merged(mart, ["g"], "label", "n", k)
    shown = F.when(F.col("privacy_merged"), "Other").otherwise(F.col("label")).alias("label")
    return marked.select("g", shown, "n", "privacy_merged").groupBy("g", "label").agg(
        F.bool_or("privacy_merged").alias("privacy_merged"), F.count("*").alias("source_mart_row_count"), F.sum("n").alias("n")
    )


def possible(together, m, shown, k):
    """Least and largest count of a small hidden cell over all that the rule would merge like this."""
    found = set()
    for cells in itertools.combinations_with_replacement(range(together + 1), m):
        if sum(cells) != together:
            continue
        low, large = [c for c in cells if c < k], [c for c in cells if c >= k]
        lonely = 1 <= sum(low) <= k - 1
        if (not large and not (lonely and shown)) or (len(large) == 1 and lonely and large[0] <= min(shown, default=together)):
            found |= set(low)
    return min(found), max(found)


@pytest.mark.parametrize("k", [3, 7])
def test_bounds_are_those_of_all_possible_counts(spark, k):
    draw = random.Random(k)
    groups = {
        g: [draw.choice([0, 1, 2, k - 1, k, k + 1, draw.randint(0, 3 * k), 50]) for _ in range(draw.randint(1, 6))] for g in range(150)
    }
    export = exported(spark, groups, k)
    rows = {}
    for r in export.collect():
        rows.setdefault(r.g, []).append(r)
    known = {r.g: r for r in hidden_cells({k: export}, ["g"], "label", "n").collect()}
    assert set(known) == {g for g, own in rows.items() if any(r.privacy_merged for r in own)}
    for g, hidden in known.items():
        shown = [r.n for r in rows[g] if not r.privacy_merged]
        assert (hidden.lower, hidden.upper) == possible(hidden.together, hidden.cells, shown, k), groups[g]


def test_planted_disclosures(spark):
    groups = {
        1: [18, 21, 22, 300],  # 39 loans in two cells, so one has 20 to 22, and the other 17 to 19
        2: [9, 15, 300],  # 24 loans in two cells: room enough
        3: [4, 5],  # nothing but small cells, together below the threshold
        4: [30, 45, 100],  # shown at 20, though 60 is the threshold of the other export
        5: [100, 200],
    }
    totals = spark.createDataFrame([(g, sum(c)) for g, c in groups.items()], "g int, total long")
    small = exported(spark, groups, 20)
    found = {(r.g, r.cell): tuple(r)[2:] for r in disclosures({20: small}, ["g"], "label", "n", totals).collect()}
    assert found == {(1, None): (17, 19, BOUNDS), (3, None): (0, 9, TOTAL)}
    # Leaving the small bucket out does not help where the total is published.
    strict = small.filter("NOT privacy_merged OR n >= 20").unionByName(small.filter("g = 3").limit(0))
    third = spark.createDataFrame([(3, "c9", False, 1, 80)], "g int, label string, privacy_merged boolean, source_mart_row_count long, n long")
    strict = strict.unionByName(third)
    totals = totals.withColumn("total", F.when(F.col("g") == 3, F.lit(89)).otherwise(F.col("total")))
    found = {(r.g, r.cell): tuple(r)[2:] for r in disclosures({20: strict}, ["g"], "label", "n", totals).collect()}
    assert found[3, None] == (0, 9, TOTAL)
    assert (3, None) not in {(r.g, r.cell) for r in disclosures({20: strict}, ["g"], "label", "n").collect()}
    # A second export with another threshold: the first one shows what that one hides.
    both = {20: small, 60: exported(spark, groups, 60)}
    found = {(r.g, r.cell, r.reason) for r in disclosures(both, ["g"], "label", "n").collect()}
    assert {(4, "c0", SHOWN), (4, "c1", SHOWN)} <= found and not any(g == 5 for g, _, _ in found)
    assert disclosures({20: small.limit(0)}, ["g"], "label", "n").collect() == []
