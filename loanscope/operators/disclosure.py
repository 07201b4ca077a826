"""What published tables tell together about cells that were merged to hide them.

A reader knows the threshold, the rule, the counts that are shown, how many cells a merged
bucket holds and the total of the group. Other exports of the same run show other cells. From
all of that each hidden cell has a least and a largest possible count; cells for which these
lie close together are not hidden. Tables are marts: a group is one month and dimension (or
one cohort), so everything here is a few aggregations of small tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reasons, as reported.
SHOWN = "shown at a lower threshold"
TOTAL = "hidden cells together below the threshold"
BOUNDS = "bounds leave little room"


def hidden_cells(
    exports: dict[int, DataFrame], group: list[str], label: str, count: str,
    totals: DataFrame | None = None,
) -> DataFrame:
    """What is known of the cells that no export shows, one row per group that has some.

    ``exports`` are exports of one run by threshold, each with ``privacy_merged`` and
    ``source_mart_row_count``. ``totals`` has the group's columns, or some of them, and ``total``.

    Returns the group, ``cells`` (NULL if only the total tells that there are some), ``together``
    (the loans in them), and ``lower`` and ``upper``, the bounds of the count of a cell that is
    below the smallest threshold.
    """
    parts = [
        table.select(
            *group, F.col(label).alias("label"), F.col(count).cast("bigint").alias("n"),
            F.col("privacy_merged").alias("merged"), F.col("source_mart_row_count").alias("cells"), F.lit(k).alias("k"),
        )
        for k, table in exports.items()
    ]
    rows = reduce(DataFrame.unionByName, parts)
    # Of one run a cell has one count, wherever it is shown.
    named = rows.filter("NOT merged").groupBy(*group, "label").agg(F.max("n").alias("n"))
    named = named.groupBy(*group).agg(F.sum("n").alias("named"), F.count("*").alias("named_cells"))
    own = lambda value: F.coalesce(F.sum(F.when(~F.col("merged"), value)), F.lit(0))
    bucket = lambda value: F.sum(F.when(F.col("merged"), F.col(value)))
    each = rows.groupBy(*group, "k").agg(
        own(F.col("n")).alias("shown"), own(F.lit(1)).alias("shown_cells"),
        F.min(F.when(~F.col("merged"), F.col("n"))).alias("least_shown"),
        bucket("n").alias("bucket"), bucket("cells").alias("bucket_cells"),
    )
    told = each.join(named, group, "left").fillna(0, ["named", "named_cells"])
    # A bucket less those of its cells that another export shows.
    rest = F.col("bucket") - (F.col("named") - F.col("shown"))
    cells = F.col("bucket_cells") - (F.col("named_cells") - F.col("shown_cells"))
    known = told.groupBy(*group).agg(
        F.max(rest).alias("together"), F.max(cells).alias("cells"), F.max("named").alias("named"),
        F.min("k").alias("k"), F.min_by("least_shown", "k").alias("least_shown"),
    )
    if totals is not None:
        on = [c for c in group if c in totals.columns]
        known = known.join(totals.select(*on, "total"), on, "left")
        known = known.withColumn("together", F.coalesce("together", F.col("total") - F.col("named")))
    known = known.filter("together > 0 OR cells > 0")
    lower, upper = _bounds(F.col("together"), F.col("cells"), F.col("k"), F.col("least_shown"))
    return known.select(
        *group, F.col("cells").cast("bigint").alias("cells"), F.col("together").cast("bigint").alias("together"),
        lower.cast("bigint").alias("lower"), upper.cast("bigint").alias("upper"),
    )


def _bounds(together: Column, cells: Column, k: Column, least_shown: Column) -> tuple[Column, Column]:
    """Least and largest count of a hidden cell below k.

    Either all hidden cells are below k, or one of k or more joined them because the others held
    1 to k - 1 loans together; that one is not larger than any cell shown. The bounds are those of
    both cases as far as they are possible; with one cell, or an unknown number, the sum bounds it.
    """
    zero = F.lit(0).cast("bigint")
    others = cells - 1
    all_low = together <= cells * (k - 1)
    low_least = F.greatest(zero, together - others * (k - 1))
    low_most = F.least(k - 1, together)
    # The loans of the low cells if one cell joined them.
    rest_least = F.greatest(F.lit(1), together - F.coalesce(least_shown, together))
    rest_most = F.least(k - 1, together - k)
    joined = (cells > 1) & (rest_least <= rest_most)
    one_low = cells == 2
    joined_least = F.when(one_low, rest_least).otherwise(zero)
    # Short of k only by the rule: a bucket of all low cells is never between 1 and k - 1 where a safe one exists.
    safe = least_shown.isNotNull()
    all_low = all_low & ~(safe & together.between(F.lit(1), k - 1))
    lower = F.least(F.when(all_low, low_least), F.when(joined, joined_least))
    upper = F.greatest(F.when(all_low, low_most), F.when(joined, rest_most))
    unknown = cells.isNull()
    return (
        F.when(unknown, zero).when(cells == 1, together).otherwise(lower),
        F.when(unknown | (cells == 1), together).otherwise(upper),
    )


def disclosures(
    exports: dict[int, DataFrame], group: list[str], label: str, count: str,
    totals: DataFrame | None = None, room: int | None = None,
) -> DataFrame:
    """Cells that readers of all exports can tell to be small: the group, ``cell``, ``lower``,
    ``upper`` and ``reason``.

    The threshold that counts is the largest one. Reported are cells that an export with a
    smaller threshold shows, groups whose hidden cells together hold fewer loans than the
    threshold (``cell`` is NULL), and groups with a hidden cell whose bounds leave fewer than
    ``room`` possible counts (a quarter of the smallest threshold by default).
    """
    highest, lowest = max(exports), min(exports)
    room = max(2, lowest // 4) if room is None else room
    shown = [
        table.filter(~F.col("privacy_merged") & (F.col(count) < highest)).select(*group, F.col(label).alias("cell"), F.col(count).cast("bigint").alias("lower"))
        for table in exports.values()
    ]
    shown = reduce(DataFrame.unionByName, shown).distinct()
    shown = shown.select(*group, "cell", "lower", F.col("lower").alias("upper"), F.lit(SHOWN).alias("reason"))
    hidden = hidden_cells(exports, group, label, count, totals).withColumn("cell", F.lit(None).cast("string"))
    small = F.col("together").between(1, highest - 1)
    narrow = (F.col("upper") - F.col("lower") + 1 < room) & (F.col("together") > 0)
    reason = F.when(small, F.lit(TOTAL)).when(narrow, F.lit(BOUNDS))
    hidden = hidden.withColumn("reason", reason).filter("reason IS NOT NULL")
    return shown.unionByName(hidden.select(*group, "cell", "lower", "upper", "reason"))


SEGMENT_GROUP, COHORT_GROUP = ["as_of_month", "segment_name"], ["from_month", "from_state"]


def segment_disclosures(exports: dict[int, DataFrame], monthly: DataFrame | None = None, room: int | None = None) -> DataFrame:
    """:func:`disclosures` of segment exports; months give the totals where they are published."""
    totals = None if monthly is None else monthly.select("as_of_month", F.col("on_book_loan_count").alias("total"))
    return disclosures(exports, SEGMENT_GROUP, "segment_value", "on_book_loan_count", totals, room)


def transition_disclosures(exports: dict[int, DataFrame], room: int | None = None) -> DataFrame:
    """:func:`disclosures` of transition exports, cohort by cohort."""
    return disclosures(exports, COHORT_GROUP, "to_state", "transition_loan_count", None, room)
