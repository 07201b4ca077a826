"""Validation of the raw files ahead of a build."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanscope.domain import VINTAGES
from loanscope.operators.raw_profile import (
    counted_codes,
    file_summary,
    frequent_codes,
    has_unusual_codes,
    raw_failures,
    raw_profile,
    reduce_origination,
    reduce_performance,
    unusual_codes,
    write_report,
)
from loanscope.sources.delimited import (
    DATASETS,
    dataset_glob,
    expected_file,
    require_files,
    scan_lines,
)
from loanscope.sources.storage import scratch_dir, written


@dataclass(frozen=True)
class RawValidation:
    passed: bool
    profile: DataFrame
    failures: DataFrame


def profile_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Profile of both file sets, each scanned once, and again only for unusual codes."""
    scratch = scratch_dir(spark, "profile")
    paths = {dataset: dataset_glob(raw_dir, dataset) for dataset in DATASETS}
    lines = {dataset: scan_lines(spark, path) for dataset, path in paths.items()}
    reducers = {"origination": reduce_origination, "performance": reduce_performance}
    origination, performance = (
        written(reducer(lines[dataset]), f"{scratch}/{dataset}") for dataset, reducer in reducers.items()
    )
    codes = None
    if has_unusual_codes(performance):
        unusual = written(unusual_codes(lines["performance"]), f"{scratch}/unusual")
        frequent = written(frequent_codes(unusual), f"{scratch}/frequent")
        codes = written(counted_codes(unusual, frequent), f"{scratch}/codes")
    return raw_profile(origination, performance, codes)


def validate_raw(
    spark: SparkSession,
    raw_dir: str,
    expected_rows: dict[tuple[str, int], int],
    report_dir: str,
    years: Iterable[int] = VINTAGES,
) -> RawValidation:
    """Profile the files, judge the profile and store both as JSON lines."""
    require_files(spark, raw_dir, years)
    profile = written(profile_files(spark, raw_dir), f"{scratch_dir(spark, 'judged')}/profile")
    failures = raw_failures(profile, expected_rows)
    files = {
        (dataset, year): expected_file(raw_dir, dataset, year) for year in years for dataset in DATASETS
    }
    summary = file_summary(profile, failures, files)
    write_report({"profile": profile, "failures": failures, "files": summary}, report_dir)
    return RawValidation(failures.isEmpty(), profile, failures)
