"""Full rebuild: raw files to checked, published marts.

Work on loan-months, in order:

* staging parses the files into parquet without an exchange;
* the key checks exchange one row of month bitmaps per loan. A repeated or missing key ends
  the build here, as a unique constraint would: everything after it relies on one row per
  loan and month, and joins on repeated ids could grow without bound;
* the narrow performance columns are hash-partitioned by loan, once, for both the
  join with the dimension and the clustered panel. Everything that follows a loan
  through time reads the clusters without another exchange.

Every table is written once under a fresh run folder and read back, which also
cuts lineage: a lost executor costs its tasks, not the run.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.domain import VINTAGES
from loanscope.operators.curated import dim_loan, fact_loan_month, next_month_pairs_ordered
from loanscope.operators.marts import (
    in_key_order,
    monthly_flows,
    portfolio_by_segment,
    portfolio_monthly,
    transitions_of,
)
from loanscope.operators.quality import (
    DETAILS,
    Expectations,
    Layers,
    extra_results,
    failed_checks,
    failure_counts,
    origination_pass,
    performance_pass,
    reduced_months,
    reported,
    validation_summary,
)
from loanscope.operators.staging import stage_origination, stage_performance
from loanscope.sources.delimited import require_files, scan_origination, scan_performance
from loanscope.sources.publication import Lease, Retention
from loanscope.sources.storage import RunStore, drop_former_runs, new_run_id, publish, stored_bytes

BYTES_PER_BUCKET = 256 << 20

REPORTED_TABLES = [
    "curated.fact_loan_month",
    "mart.delinquency_transition_monthly",
    "mart.portfolio_monthly",
    "mart.portfolio_monthly_by_segment",
    "staging.monthly_performance",
    "staging.origination",
]


class ValidationFailed(RuntimeError):
    """Checks failed, so the run was not published."""

    def __init__(self, failures: list[tuple[str, int, str]], store: RunStore):
        lines = [f"{name}: {count} failed rows ({details})" for name, count, details in failures]
        super().__init__("Validation failed:\n- " + "\n- ".join(lines))
        self.failures = failures
        self.store = store


@dataclass(frozen=True)
class BuildReport:
    store: RunStore
    row_counts: DataFrame
    summary: DataFrame
    #: Wall-clock seconds of each step, in order.
    seconds: dict[str, float]


def bucket_count(
    spark: SparkSession, stored: int, share: float = 1.0, most: int | None = None
) -> int:
    """Buckets of about 256 MB of the panel, and at least one per default task slot.

    ``stored`` are the bytes of the staged table and ``share`` the part of its columns that
    the panel keeps. ``most`` limits the number, by default to what the session allows for a
    table (``spark.sql.sources.bucketing.maxBuckets``). At the limit buckets grow with the
    data; no row is lost, but then raise both.
    """
    if most is None:
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    wanted = max(spark.sparkContext.defaultParallelism, -(-int(stored * share) // BYTES_PER_BUCKET))
    return min(most, wanted)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` per table, ordered by name."""
    counts = (
        table.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables.items()
    )
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def clustered_panel(performance: DataFrame, dim: DataFrame, buckets: int) -> DataFrame:
    """The panel hash-partitioned by loan, for keys known to be unique.

    Partitioning the performance side before the join makes one exchange serve
    the join and the clustered write.
    """
    return fact_loan_month(performance.repartition(buckets, "loan_id"), dim)


def _written_together(store: RunStore, tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Write independent tables as concurrent jobs, so that one fills the other's gaps."""
    with ThreadPoolExecutor(len(tables)) as jobs:
        return list(jobs.map(store.write, tables.keys(), tables.values()))


def _require_passed(results: DataFrame, store: RunStore) -> None:
    # One row per check, so this is small whatever the data holds.
    failures = [tuple(row) for row in failed_checks(results).collect()]
    if failures:
        raise ValidationFailed(failures, store)


class _Steps:
    """Seconds since the step before, by step; each renews the lease on the run."""

    def __init__(self, lease: Lease):
        self.seconds: dict[str, float] = {}
        self._lease = lease
        self._last = time.perf_counter()

    def done(self, name: str) -> None:
        self._lease.renew()
        now = time.perf_counter()
        self.seconds[name] = round(now - self._last, 3)
        self._last = now


PANEL = "curated.fact_loan_month"
#: Buckets by loan serve whatever follows a loan through time, the order in them filters by month.
PANEL_ORDER = ["as_of_month", "loan_id"]
KEY_CHECKS = ["origination_loan_id_unique", "performance_loan_month_unique"]


def build(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    expect: Expectations,
    years: Iterable[int] = VINTAGES,
    most_buckets: int | None = None,
    retention: Retention | None = Retention(),
) -> BuildReport:
    """Rebuild every table from the raw files and publish if all checks pass.

    Raises :class:`ValidationFailed` otherwise; the published version stays. A build that
    publishes drops the runs that ``retention`` no longer keeps (None keeps all); its own
    files, and those of a run that somebody reads under a lease, stay.
    """
    require_files(spark, raw_dir, years)
    store = RunStore(spark, root, new_run_id())
    with store.lease() as lease:
        report = _built(spark, raw_dir, store, expect, most_buckets, _Steps(lease))
        if retention is not None:
            drop_former_runs(spark, root, retention)
    return report


def _built(
    spark: SparkSession,
    raw_dir: str,
    store: RunStore,
    expect: Expectations,
    most_buckets: int | None,
    steps: _Steps,
) -> BuildReport:
    origination, performance = _written_together(
        store,
        {
            "staging.origination": stage_origination(scan_origination(spark, raw_dir)),
            "staging.monthly_performance": stage_performance(scan_performance(spark, raw_dir)),
        },
    )
    steps.done("staging")
    dim = store.write("curated.dim_loan", dim_loan(origination))
    steps.done("dimension")

    # One exchange of loans serves the key checks, the coverage and the count of pairs.
    months = store.write("quality.loan_months", reduced_months(performance, expect))
    staged = Layers(origination=origination, performance=performance, loan_months=months)
    key_counts = failure_counts(staged, expect, KEY_CHECKS)
    keys = store.write("quality.key_checks", reported(key_counts, DETAILS))
    _require_passed(keys, store)
    steps.done("key checks")

    panel = fact_loan_month(performance, dim)
    buckets = bucket_count(
        spark,
        stored_bytes(spark, store.table_path("staging.monthly_performance")),
        len(panel.columns) / len(performance.columns),
        most_buckets,
    )
    try:
        fact = store.write_clustered(
            PANEL,
            clustered_panel(performance, dim, buckets),
            by="loan_id",
            order=PANEL_ORDER,
            buckets=buckets,
        )
        steps.done("panel")
        # One window over the panel: flows keep what the mart and the pair checks need. The
        # scans of staging for the checks fill the gaps of the marts.
        monthly, segments, flows, *passes = _written_together(
            store,
            {
                "mart.portfolio_monthly": in_key_order(portfolio_monthly(fact)),
                "mart.portfolio_monthly_by_segment": in_key_order(portfolio_by_segment(fact)),
                "curated.monthly_flows": monthly_flows(next_month_pairs_ordered(fact)),
                "quality.origination_pass": origination_pass(origination),
                "quality.performance_pass": performance_pass(performance, expect),
            },
        )
        transitions = store.write(
            "mart.delinquency_transition_monthly", in_key_order(transitions_of(flows))
        )
        steps.done("marts and passes")
        layers = Layers(
            origination=origination,
            performance=performance,
            fact=fact,
            monthly=monthly,
            segments=segments,
            transitions=transitions,
            origination_pass=passes[0],
            performance_pass=passes[1],
            loan_months=months,
            flows=flows,
        )
        others = [name for name in DETAILS if name not in KEY_CHECKS]
        counts = reported(failure_counts(layers, expect, others), DETAILS)
        results = store.write("quality.validation_results", keys.unionByName(counts))
        extra = store.write("quality.extra_results", extra_results(layers))
    finally:
        store.forget(PANEL)
    _require_passed(results.unionByName(extra), store)
    publish(store)
    steps.done("gate")
    return BuildReport(
        store=store,
        row_counts=table_row_counts({name: store.read(name) for name in REPORTED_TABLES}),
        summary=validation_summary(results),
        seconds=steps.seconds,
    )
