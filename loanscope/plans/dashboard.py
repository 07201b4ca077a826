"""Export of the published marts as suppressed aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.domain import MIN_CELL_COUNT
from loanscope.operators.export_quality import (
    dashboard_input_problems,
    export_results,
    stored_gaps,
)
from loanscope.operators.exports import (
    MONTHLY_FIELDS,
    SEGMENT_FIELDS,
    TRANSITION_FIELDS,
    export_monthly,
    in_display_order,
)
from loanscope.operators.quality import failed_checks
from loanscope.operators.suppression import (
    require_threshold,
    suppress_segments,
    suppress_transitions,
)
from loanscope.sources.csv_tables import read_csv, write_csv
from loanscope.sources.publication import (
    Folder,
    Lease,
    Retention,
    current_version,
    publish_version,
    sweep,
)
from loanscope.sources.storage import RunStore, new_run_id, opened_run


class ExportRejected(RuntimeError):
    """Export checks failed, so nothing was handed out."""


@dataclass(frozen=True)
class DashboardTables:
    monthly: DataFrame
    segments: DataFrame
    transitions: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return dict(zip(FIELDS, (self.monthly, self.segments, self.transitions), strict=True))


#: Folder of the versions of an export.
VERSIONS = "versions"

# file name -> fields the dashboard reads back
FIELDS = {
    "portfolio_monthly": MONTHLY_FIELDS,
    "portfolio_monthly_by_segment": SEGMENT_FIELDS,
    "delinquency_transition_monthly": TRANSITION_FIELDS,
}


def dashboard_tables(store: RunStore, k: int = MIN_CELL_COUNT) -> DashboardTables:
    """The three exports of a run, computed from its marts; the run is only read."""
    return DashboardTables(
        monthly=export_monthly(store.read("mart.portfolio_monthly")),
        segments=suppress_segments(store.read("mart.portfolio_monthly_by_segment"), k),
        transitions=suppress_transitions(store.read("mart.delinquency_transition_monthly"), k),
    )


def _require_passed(report: DataFrame) -> None:
    failures = failed_checks(report).collect()
    if failures:
        lines = [f"{row.check_name}: {row.failed_row_count} failed rows" for row in failures]
        raise ExportRejected("Export checks failed:\n- " + "\n- ".join(lines))


def export(
    spark: SparkSession,
    root: str,
    out_dir: str,
    k: int = MIN_CELL_COUNT,
    retention: Retention | None = Retention(),
) -> DataFrame:
    """Export the published run as CSV, if all checks pass before and after it is stored.

    The tables are checked against the marts and then written as a new version. That version
    is read back as a dashboard reads it, and must have rows in every table, unique keys, the
    months of the run, no identifier, and the rows that were computed. Only then does it
    count. :class:`ExportRejected` or any other failure on the way leaves the former version
    current, and a rejected version is deleted. Returns the report of all checks.

    Marts hold months x labels, so the checks cost little. ``retention`` says which former
    versions stay; None keeps all.
    """
    require_threshold(k)
    version = new_run_id()
    with opened_run(spark, root) as store, Lease(spark, out_dir, version):
        tables = dashboard_tables(store, k)
        monthly = store.read("mart.portfolio_monthly")
        report = export_results(
            tables.monthly,
            tables.segments,
            tables.transitions,
            monthly,
            store.read("mart.delinquency_transition_monthly"),
            k,
        )
        _require_passed(report)
        try:
            for name, table in tables.by_name().items():
                write_csv(in_display_order(table), _table_path(out_dir, version, name))
            stored = _stored_results(spark, out_dir, version, tables, monthly)
            _require_passed(stored)
        except Exception:
            Folder(spark, f"{out_dir}/{VERSIONS}").delete(version)
            raise
        publish_version(spark, out_dir, version)
        if retention is not None:
            sweep(spark, out_dir, VERSIONS, retention)
    return report.unionByName(stored)


def _stored_results(
    spark: SparkSession, out_dir: str, version: str, tables: DashboardTables, monthly: DataFrame
) -> DataFrame:
    """Check report of a stored version, kept on the driver: one row for each check."""
    stored = _load(spark, out_dir, version)
    window = monthly.agg(
        F.count("*").alias("months"),
        F.min("as_of_month").cast("string").alias("first"),
        F.max("as_of_month").cast("string").alias("last"),
    ).first()
    usable = dashboard_input_problems(
        stored.monthly, stored.segments, stored.transitions, window.months, window.first, window.last
    )
    results = usable.unionByName(stored_gaps(tables.by_name(), stored.by_name(), FIELDS))
    return spark.createDataFrame(results.collect(), results.schema)


def _table_path(out_dir: str, version: str, name: str) -> str:
    return f"{out_dir}/{VERSIONS}/{version}/{name}"


def _load(spark: SparkSession, out_dir: str, version: str) -> DashboardTables:
    return DashboardTables(
        *(
            read_csv(spark, _table_path(out_dir, version, name), fields)
            for name, fields in FIELDS.items()
        )
    )


def load_export(spark: SparkSession, out_dir: str) -> DashboardTables:
    """The tables exported last, as the dashboard reads them.

    A version counts only after its checks, so each table has rows.
    """
    version = current_version(spark, out_dir)
    if version is None:
        raise FileNotFoundError(f"no export in {out_dir}")
    return _load(spark, out_dir, version)


def check_dashboard(
    tables: DashboardTables, month_count: int, first_month: str, last_month: str
) -> None:
    """Raise unless the loaded tables are usable and span the expected window."""
    _require_passed(
        dashboard_input_problems(
            tables.monthly,
            tables.segments,
            tables.transitions,
            month_count,
            first_month,
            last_month,
        )
    )
