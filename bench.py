"""Times the headline operators and prints one JSON line.

Operators run on stored tables: the panel of ``$BENCH_SF_DIR`` is derived once and
written, so that a time is the operator's own. The same operators run again on the
panel replicated to about 4.75 million loan-months at sf0.1, which comes from raw
files through a full build, whose steps are timed apart.

Environment: ``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_REPLICAS`` (0 leaves the
replicated panel out), ``BENCH_MEMORY``.
"""

from __future__ import annotations

import json
import os
import platform
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.domain import ORIGINATION_FIELDS, PERFORMANCE_FIELDS, VINTAGES
from loanscope.operators.curated import next_month_pairs_ordered
from loanscope.operators.marts import portfolio_by_segment, portfolio_monthly, transition_monthly
from loanscope.operators.panels import migration_matrix
from loanscope.operators.quality import Expectations, Layers, failure_counts
from loanscope.operators.staging import stage_performance
from loanscope.operators.suppression import suppress_segments, suppress_transitions
from loanscope.plans.build import build
from loanscope.plans.dashboard import dashboard_tables
from loanscope.sources import delimited, storage
from loanscope.testbed import panel

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MEMORY = os.environ.get("BENCH_MEMORY", "16g")
REPLICAS = int(os.environ.get("BENCH_REPLICAS", "11"))

SETTINGS = {
    "spark.sql.shuffle.partitions": CPUS,
    "spark.sql.adaptive.enabled": "true",
    "spark.driver.memory": MEMORY,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def drain(table: DataFrame) -> None:
    """Run a query to its last row and column without collecting it."""
    table.write.format("noop").mode("overwrite").save()


def headline(
    raw: DataFrame, staged: DataFrame, origination: DataFrame, fact: DataFrame, expect: Expectations
) -> dict[str, Callable[[], DataFrame]]:
    """The operators by name, on stored tables."""
    pairs = next_month_pairs_ordered(fact)
    return {
        "stage_performance": lambda: stage_performance(raw),
        "portfolio_monthly": lambda: portfolio_monthly(fact),
        "portfolio_by_segment": lambda: portfolio_by_segment(fact),
        "transition_monthly": lambda: transition_monthly(pairs),
        "suppress_segments": lambda: suppress_segments(portfolio_by_segment(fact), 20),
        "suppress_segments_k400": lambda: suppress_segments(portfolio_by_segment(fact), 400),
        "suppress_transitions": lambda: suppress_transitions(transition_monthly(pairs), 20),
        "checks_of_staged_rows": lambda: failure_counts(
            Layers(origination=origination, performance=staged), expect,
            ["source_row_counts", "performance_months_valid", "zero_balance_codes_valid",
             "origination_performance_coverage"],
        ),
        "panel_matrix_count": lambda: migration_matrix(
            suppress_transitions(transition_monthly(pairs), 20), "2023-05-01", "transition_loan_count"
        ),
    }


def replicated_files(spark: SparkSession) -> tuple[str, Expectations]:
    """Raw files of the panel repeated under new loan ids."""
    raw_dir = storage.scratch_dir(spark, "bench")
    copies = F.explode(F.sequence(F.lit(0), F.lit(REPLICAS - 1))).alias("copy")
    # Loan numbers move by a multiple of four, so vintages and quarters stay put.
    largest = panel.table(spark, SF_DIR, "customer").agg(F.max("c_custkey")).first()[0]
    offset = 4 * (largest // 4 + 1)
    loan_id = F.concat(
        F.substring("loan_id", 1, 5), F.format_string("%07d", F.col("k") + F.col("copy") * offset)
    )
    rows = {}
    for dataset, source, fields in (
        ("origination", panel.raw_origination(spark, SF_DIR), ORIGINATION_FIELDS),
        ("performance", panel.raw_performance(spark, SF_DIR), PERFORMANCE_FIELDS),
    ):
        part = delimited.DATASETS[dataset][0]
        renumbered = source.select("*", copies).withColumn("loan_id", loan_id)
        stored = storage.written(
            delimited.as_lines(renumbered, fields).select("source_year", "value"),
            f"{raw_dir}/lines/{dataset}",
        )
        for year in VINTAGES:
            lines = stored.filter(F.col("source_year") == year).select("value")
            lines.write.text(f"{raw_dir}/sample_{year}/sample_{part}_{year}.txt")
        rows[dataset] = {r[0]: r[1] for r in stored.groupBy("source_year").count().collect()}
    expect = Expectations(
        rows["origination"], rows["performance"], panel.WINDOW_END, panel.SPOT_MONTHS
    )
    return raw_dir, expect


def main() -> None:
    spark = session()
    root = storage.scratch_dir(spark, "bench-panel")
    store = storage.RunStore(spark, root, "sf")
    raw = store.write("raw", panel.raw_performance(spark, SF_DIR))
    staged = store.write("staged", panel.staged_performance(spark, SF_DIR))
    origination = store.write("origination", panel.staged_origination(spark, SF_DIR))
    fact = store.write("fact", panel.fact(spark, SF_DIR))
    rows = panel.expected_rows(spark, SF_DIR)
    expect = Expectations(
        rows["origination"], rows["performance"], panel.WINDOW_END, panel.SPOT_MONTHS
    )
    operators = headline(raw, staged, origination, fact, expect)
    for operator in operators.values():  # start-up and code generation, not reported
        drain(operator())
    seconds = {name: timed(lambda run=run: drain(run())) for name, run in operators.items()}

    replicated = {}
    if REPLICAS:
        raw_dir, expect = replicated_files(spark)
        reports = []
        root = storage.scratch_dir(spark, "bench-build")
        replicated["full_build"] = timed(lambda: reports.append(build(spark, raw_dir, root, expect)))
        replicated["build_steps"] = reports[0].seconds
        replicated["exports"] = timed(
            lambda: [drain(t) for t in vars(dashboard_tables(reports[0].store, 400)).values()]
        )
        built = reports[0].store
        operators = headline(
            delimited.scan_performance(spark, raw_dir),
            built.read("staging.monthly_performance"),
            built.read("staging.origination"),
            built.read("curated.fact_loan_month"),
            expect,
        )
        replicated["queries"] = {
            name: timed(lambda run=run: drain(run())) for name, run in operators.items()
        }
        replicated["loan_months"] = sum(expect.performance_rows.values())

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline operators on a stored panel",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "loan_months": sum(rows["performance"].values()),
                "replicated_panel": replicated,
                "machine": {"cpus": CPUS, "arch": platform.machine()},
                "settings": SETTINGS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
