"""Profile of the raw files and the failures it implies.

Each file set is scanned and parsed once. The scan reduces to one row of counters
per year and loan, and that much smaller table answers nearly everything: totals,
repeated ids, coverage between the two file sets and overlap between vintages.

Files with unusual codes are scanned again for their histogram. A shifted column can
have as many codes as lines, so a sketch of bounded size finds the frequent ones, these
are counted exactly, and the rest is one row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.domain import (
    NON_NUMERIC_STATUSES,
    ORIGINATION_FIELDS,
    PERCENT_MISSING,
    PERFORMANCE_FIELDS,
    SCORE_MISSING,
    ZERO_BALANCE_CODES,
)
from loanscope.functions.parsing import TWO_DIGITS, is_number, is_valid_month
from loanscope.sources.delimited import split_fields
from loanscope.sources.publication import current_version, publish_version
from loanscope.sources.storage import new_run_id

# Fixed field lists of the checks.
ORIGINATION_REQUIRED = [
    "classic_fico",
    "first_payment_date",
    "maturity_date",
    "original_cltv",
    "original_dti",
    "original_upb",
    "loan_id",
]
ORIGINATION_DATES = ["first_payment_date", "maturity_date"]
ORIGINATION_NUMBERS = [
    "classic_fico",
    "original_cltv",
    "original_dti",
    "original_upb",
    "original_ltv",
    "original_interest_rate",
    "original_loan_term",
    "vantage_score_4",
]
ORIGINATION_SENTINELS = {
    "classic_fico": SCORE_MISSING,
    "vantage_score_4": SCORE_MISSING,
    "mi_percentage": PERCENT_MISSING,
    "original_cltv": PERCENT_MISSING,
    "original_dti": PERCENT_MISSING,
    "original_ltv": PERCENT_MISSING,
}
PERFORMANCE_REQUIRED = [
    "loan_id",
    "period",
    "current_actual_upb",
    "current_loan_delinquency_status",
    "loan_age",
]
PERFORMANCE_NUMBERS = ["current_actual_upb", "loan_age"]

# Metrics that must be zero; the others are informational.
MUST_BE_ZERO = [
    "rows_with_wrong_field_count",
    "rows_with_non_ascii_text",
    "duplicate_loan_ids",
    "invalid_required_dates",
    "nonnumeric_values_in_numeric_fields",
    "invalid_periods",
    "nonnumeric_upb_or_loan_age",
    "invalid_delinquency_statuses",
    "invalid_zero_balance_codes",
    "performance_loans_without_origination",
    "originations_without_performance",
    "cross_vintage_loan_id_overlap",
]

_PROFILE = ["dataset", "source_year", "metric", "item", "value"]


def _present(field: str) -> str:
    """Field text with blanks as empty strings."""
    return f"coalesce({field}, '')"


def _usable(*conditions: str) -> str:
    """How often conditions hold in well-formed lines."""
    hits = " + ".join(f"int({condition})" for condition in conditions)
    return f"sum({hits}) FILTER (WHERE NOT is_malformed)"


_LINE_COUNTERS = {
    "row_count": "count(*)",
    "rows_with_wrong_field_count": "count_if(is_malformed)",
    "rows_with_non_ascii_text": r"count_if(value RLIKE r'[^\x00-\x7F]')",
}


def _missing_counters(fields: list[str]) -> dict[str, str]:
    return {
        f"missing_important_fields:{name}": _usable(f"{_present(name)} = ''") for name in fields
    }


def _counted(rows: DataFrame, keys: list[Column], counters: dict[str, str]) -> DataFrame:
    columns = (F.expr(counter).cast("bigint").alias(name) for name, counter in counters.items())
    return rows.groupBy("source_year", *keys).agg(*columns)


def reduce_origination(lines: DataFrame) -> DataFrame:
    """Counters per year and loan over the origination lines."""
    sentinels = {
        f"official_sentinel_counts:{name}={code}": _usable(f"{_present(name)} = '{code}'")
        for name, code in ORIGINATION_SENTINELS.items()
    }
    counters = {
        **_LINE_COUNTERS,
        "invalid_required_dates": _usable(
            *(f"NOT ({is_valid_month(name)})" for name in ORIGINATION_DATES)
        ),
        "nonnumeric_values_in_numeric_fields": _usable(
            *(f"NOT ({is_number(name)})" for name in ORIGINATION_NUMBERS)
        ),
        **_missing_counters(ORIGINATION_REQUIRED),
        **sentinels,
    }
    return _counted(split_fields(lines, ORIGINATION_FIELDS), [_loan()], counters)


def _loan() -> Column:
    """Loan id of a usable line; malformed lines share a NULL id."""
    return F.expr(f"if(is_malformed, NULL, {_present('loan_id')}) AS loan_id")


#: Codes shown for each year and metric, and codes that the sketch behind them follows. A code is
#: sure to be found if its share of the unusual ones is above a few times 1 / TRACKED_CODES.
SHOWN_CODES, TRACKED_CODES = 100, 10_000
#: Longer text is no code; it counts with the rest.
LONGEST_CODE = 100
#: Item of the unusual codes that are not shown.
OTHER_CODES = "<other>"

_STATUS, _CODE = _present("current_loan_delinquency_status"), _present("zero_balance_code")
#: metric -> (condition of a usual value, how a value is shown)
_CODED = {
    "invalid_delinquency_statuses": (
        f"{_STATUS} RLIKE r'{TWO_DIGITS}' OR {_STATUS} IN ({', '.join(repr(n) for n in NON_NUMERIC_STATUSES)})",
        f"if({_STATUS} = '', '<blank>', {_STATUS})",
    ),
    "invalid_zero_balance_codes": (
        f"{_CODE} IN ({', '.join(repr(n) for n in ['', *ZERO_BALANCE_CODES])})", _CODE
    ),
}


def reduce_performance(lines: DataFrame) -> DataFrame:
    """Counters per year and loan over the performance lines."""
    usable_period = f"NOT is_malformed AND {is_valid_month('period')}"
    valid_period = f"(try_cast(period AS bigint)) FILTER (WHERE {usable_period})"
    counters = {
        **_LINE_COUNTERS,
        "invalid_periods": _usable(f"NOT ({is_valid_month('period')})"),
        "nonnumeric_upb_or_loan_age": _usable(
            *(f"NOT ({is_number(name)})" for name in PERFORMANCE_NUMBERS)
        ),
        **_missing_counters(PERFORMANCE_REQUIRED),
        "min_performance_month": f"min{valid_period}",
        "max_performance_month": f"max{valid_period}",
        **{metric: _usable(f"NOT ({usual})") for metric, (usual, _) in _CODED.items()},
    }
    return _counted(split_fields(lines, PERFORMANCE_FIELDS), [_loan()], counters)


def has_unusual_codes(performance: DataFrame) -> bool:
    """Whether the reduced table counts any."""
    return not performance.filter(" OR ".join(f"{metric} > 0" for metric in _CODED)).isEmpty()


def unusual_codes(lines: DataFrame) -> DataFrame:
    """``source_year, metric, item`` of each unusual code that is short enough for one."""
    rows = split_fields(lines, PERFORMANCE_FIELDS).filter("NOT is_malformed")
    found = [
        f"if({usual}, NULL, struct('{metric}' AS metric, {shown} AS item))"
        for metric, (usual, shown) in _CODED.items()
    ]
    codes = rows.select("source_year", F.explode(F.expr(f"array({', '.join(found)})")).alias("code"))
    return codes.select("source_year", "code.*").filter(F.char_length("item") <= LONGEST_CODE)


def frequent_codes(codes: DataFrame) -> DataFrame:
    """``source_year, metric, item``: candidates for the most frequent codes, a bounded number."""
    top = F.expr(f"approx_top_k(item, {SHOWN_CODES}, {TRACKED_CODES})").alias("top")
    return codes.groupBy("source_year", "metric").agg(top).select(
        "source_year", "metric", F.explode("top.item").alias("item")
    )


def counted_codes(codes: DataFrame, frequent: DataFrame) -> DataFrame:
    """``source_year, metric, item, value``: how often the given codes occur, exactly.

    ``frequent`` has at most ``SHOWN_CODES`` rows for each year and metric, so it is broadcast.
    """
    key = ["source_year", "metric", "item"]
    return codes.join(F.broadcast(frequent), key).groupBy(*key).agg(F.count("*").alias("value"))


_COMBINE: dict[str, Callable[[str], Column]] = {
    "min_performance_month": F.min,
    "max_performance_month": F.max,
}


def _totals(reduced: DataFrame, dataset: str) -> DataFrame:
    """Counters summed per year, one row per metric and item, also where nothing was found."""
    keys = {"source_year", "loan_id", *_CODED}
    counters = [name for name in reduced.columns if name not in keys]
    per_year = reduced.groupBy("source_year").agg(
        *(_COMBINE.get(name, F.sum)(F.col(f"`{name}`")).alias(name) for name in counters)
    )
    metrics = []
    for name in counters:
        metric, _, item = name.partition(":")
        shown_item = f"'{item}'" if item else "string(NULL)"
        metrics.append(f"'{metric}', {shown_item}, coalesce(`{name}`, 0L)")
    rows = f"stack({len(metrics)}, {', '.join(metrics)}) AS (metric, item, value)"
    return (
        per_year.selectExpr(f"'{dataset}' AS dataset", "source_year", rows).select(*_PROFILE)
    )


def _histogram(reduced: DataFrame, codes: DataFrame | None, metric: str) -> DataFrame:
    """Lines per shown code and those of all others; they add up to the total of the year.

    A year without any unusual code has one row of zero without item.
    """
    totals = reduced.groupBy("source_year").agg(F.coalesce(F.sum(metric), F.lit(0)).alias("total"))
    rest = totals.withColumn("shown", F.lit(0).cast("bigint"))
    if codes is not None:
        own = codes.filter(F.col("metric") == metric)
        sums = own.groupBy("source_year").agg(F.sum("value").alias("shown"))
        rest = totals.join(sums, "source_year", "left").fillna(0, ["shown"])
    item = F.when(F.col("total") > 0, F.lit(OTHER_CODES)).alias("item")
    rest = rest.filter("total = 0 OR total > shown").select(
        "source_year", item, (F.col("total") - F.col("shown")).alias("value")
    )
    shown = rest if codes is None else rest.unionByName(own.select("source_year", "item", "value"))
    return shown.selectExpr("'performance' AS dataset", "source_year", f"'{metric}' AS metric", "item", "value")


def _count_per_year(rows: DataFrame, dataset: str, metric: str, value: Column) -> DataFrame:
    return rows.groupBy("source_year").agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).select(
        F.lit(dataset).alias("dataset"),
        "source_year",
        F.lit(metric).alias("metric"),
        F.lit(None).cast("string").alias("item"),
        "value",
    )


def raw_profile(
    origination: DataFrame, performance: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """Profile in long form: ``dataset, source_year, metric, item, value``.

    Takes the two reduced tables; store them first, since every part of the
    profile reads them. ``codes`` are the counted codes, to be given where there are unusual
    ones. Counters that found nothing are there as zero. ``source_year`` is NULL for the
    vintage overlap.
    """
    known = F.col("loan_id").isNotNull()
    originated = origination.filter(known).select("source_year", "loan_id")
    observed = performance.filter(known).select("source_year", "loan_id")
    overlap = originated.groupBy("loan_id").agg(F.count("*").alias("vintages")).filter("vintages > 1")
    # One join of the reduced ids answers both directions of the coverage.
    covered = originated.withColumn("in_origination", F.lit(True)).join(
        observed.withColumn("in_performance", F.lit(True)), ["source_year", "loan_id"], "full"
    )
    parts = [
        _totals(origination, "origination"),
        _totals(performance, "performance"),
        _count_per_year(
            origination,
            "origination",
            "duplicate_loan_ids",
            F.sum(F.when(known, F.col("row_count") - 1)),
        ),
        *(_histogram(performance, codes, metric) for metric in _CODED),
        _count_per_year(
            covered,
            "performance",
            "performance_loans_without_origination",
            F.count_if(F.col("in_origination").isNull()),
        ),
        _count_per_year(
            covered,
            "performance",
            "originations_without_performance",
            F.count_if(F.col("in_performance").isNull()),
        ),
        overlap.agg(F.count("*").alias("value")).select(
            F.lit("origination").alias("dataset"),
            F.lit(None).cast("smallint").alias("source_year"),
            F.lit("cross_vintage_loan_id_overlap").alias("metric"),
            F.lit(None).cast("string").alias("item"),
            "value",
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def raw_failures(profile: DataFrame, expected_rows: dict[tuple[str, int], int]) -> DataFrame:
    """What in a profile rules the files out: ``dataset, source_year, metric, value, message``."""
    spark = profile.sparkSession
    label = F.concat_ws(" ", F.col("source_year").cast("string"), "dataset")
    wanted = expected_counts(spark, expected_rows)
    found = profile.filter("metric = 'row_count'").select("dataset", "source_year", "value")
    miscounted = (
        wanted.join(found, ["dataset", "source_year"], "left")
        .withColumn("value", F.coalesce("value", F.lit(0)))
        .filter(F.col("value") != F.col("expected"))
        .select(
            "dataset",
            "source_year",
            F.lit("row_count").alias("metric"),
            "value",
            F.concat(label, F.lit(": expected "), "expected", F.lit(" rows")).alias("message"),
        )
    )
    nonzero = (
        profile.filter(F.col("metric").isin(MUST_BE_ZERO))
        .groupBy("dataset", "source_year", "metric")
        .agg(F.sum("value").alias("value"))
        .filter("value > 0")
        .withColumn("message", F.concat(label, F.lit(": "), "metric", F.lit("="), "value"))
    )
    return miscounted.unionByName(nonzero)


def file_summary(
    profile: DataFrame, failures: DataFrame, files: dict[tuple[str, int], str]
) -> DataFrame:
    """One row per expected file: ``dataset, source_year, file, expected_fields, passed``."""
    spark = profile.sparkSession
    fields = {"origination": len(ORIGINATION_FIELDS), "performance": len(PERFORMANCE_FIELDS)}
    rows = ", ".join(
        f"('{dataset}', {year}S, '{path}', {fields[dataset]})"
        for (dataset, year), path in files.items()
    )
    listed = spark.sql(
        f"SELECT * FROM VALUES {rows} AS files(dataset, source_year, file, expected_fields)"
    )
    # An overlap between vintages has no year and counts against every origination file.
    failed = failures.groupBy("dataset", "source_year").count().select(
        F.col("dataset").alias("failed_dataset"), F.col("source_year").alias("failed_year")
    )
    matches = (F.col("dataset") == F.col("failed_dataset")) & (
        F.col("failed_year").isNull() | (F.col("source_year") == F.col("failed_year"))
    )
    return (
        listed.join(failed, matches, "left")
        .groupBy("dataset", "source_year", "file", "expected_fields")
        .agg((F.count("failed_dataset") == 0).alias("passed"))
    )


def expected_counts(spark: SparkSession, rows: dict[tuple[str, int], int]) -> DataFrame:
    """``dataset, source_year, expected`` from a short list of files."""
    if not rows:
        return spark.sql(
            "SELECT '' AS dataset, 0S AS source_year, 0L AS expected WHERE false"
        )
    values = ", ".join(f"('{dataset}', {year}S, {n}L)" for (dataset, year), n in rows.items())
    return spark.sql(f"SELECT * FROM VALUES {values} AS wanted(dataset, source_year, expected)")


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    """Store the parts of a report as JSON lines: a new version of what the folder holds."""
    spark = next(iter(parts.values())).sparkSession
    version = new_run_id()
    for name, part in parts.items():
        part.write.json(f"{path}/versions/{version}/{name}")
    publish_version(spark, path, version)


def read_report(spark: SparkSession, path: str, part: str) -> DataFrame:
    """A part of the report stored last."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no report in {path}")
    return spark.read.json(f"{path}/versions/{version}/{part}")
