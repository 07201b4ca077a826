"""Shapes of physical plans that matter at scale."""

import datetime
import glob
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loanscope.operators import curated, marts, quality
from loanscope.plans.build import PANEL_ORDER, clustered_panel
from loanscope.sources.storage import RunStore
from loanscope.testbed import panel

SF = "/root/testdata/sf0.001"


def plan(table):
    return table._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_clustered_panel_needs_no_exchange_by_loan(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "plan")
    fact = store.write_clustered(
        "curated.fact_loan_month",
        panel.fact(spark, SF).repartition(4, "loan_id"),
        "loan_id",
        PANEL_ORDER,
        4,
        row_group_bytes=16 << 10,
    )
    text = plan(marts.transition_monthly(curated.next_month_pairs_ordered(fact)))
    assert exchanges(text)
    assert not any("loan_id" in keys for keys in exchanges(text))
    assert text.count("FileScan") == 1
    # The same files serve a month: few row groups have it in their range.
    month, held, all_ = datetime.date(2022, 5, 1), 0, 0
    for path in glob.glob(f"{store.table_path('curated.fact_loan_month')}/*.parquet"):
        footer = pq.ParquetFile(path).metadata
        at = [i for i in range(footer.num_columns) if footer.schema.column(i).name == "as_of_month"][0]
        for group in range(footer.num_row_groups):
            range_ = footer.row_group(group).column(at).statistics
            all_ += 1
            held += range_.min <= month <= range_.max
    assert all_ >= 20 and 0 < held <= all_ / 4
    one = store.read("curated.fact_loan_month").filter(F.col("as_of_month") == F.lit(month))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(as_of_month,2022-05-01\)", plan(one))
    assert one.count() == fact.filter(F.col("as_of_month") == F.lit(month)).count() > 0
    store.forget("curated.fact_loan_month")


def test_marts_scan_once_and_read_few_columns(spark, tmp_path):
    fact = RunStore(spark, str(tmp_path), "plan").write("curated.fact", panel.fact(spark, SF))
    segments = plan(marts.portfolio_by_segment(fact))
    assert segments.count("FileScan") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)", segments).group(1)
    assert "loan_id" not in schema and "source_file" not in schema
    assert "Join" not in segments and "Window" not in segments


def test_the_gate_reads_each_table_few_times(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "plan")
    expect = quality.Expectations({2019: 1}, {2019: 1}, panel.WINDOW_END, panel.SPOT_MONTHS)
    origination = store.write("staging.o", panel.staged_origination(spark, SF))
    performance = store.write("staging.p", panel.staged_performance(spark, SF))
    fact = store.write("curated.f", panel.fact(spark, SF))
    flows = marts.monthly_flows(curated.next_month_pairs_ordered(fact))
    passes = quality.origination_pass(origination), quality.performance_pass(performance, expect)
    months = quality.reduced_months(performance, expect)
    layers = quality.Layers(
        origination=origination,
        performance=performance,
        fact=fact,
        monthly=store.write("mart.m", marts.portfolio_monthly(fact)),
        segments=store.write("mart.s", marts.portfolio_by_segment(fact)),
        transitions=store.write("mart.t", marts.transitions_of(flows)),
        origination_pass=store.write("quality.o", passes[0]),
        performance_pass=store.write("quality.p", passes[1]),
        loan_months=store.write("quality.m", months),
        flows=store.write("curated.flows", flows),
    )
    names = [n for n in quality.DETAILS if n != "origination_loan_id_unique"]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)  # whole paths
    try:
        gate = plan(quality.failure_counts(layers, expect, names))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = lambda text, name: len(re.findall(rf"Location: [^\n]*{re.escape(name)}[\],]", text))
    # Rows are read for the passes and the bitmaps; the key check adds none where loans are clear.
    assert plan(passes[1]).count("FileScan") == 1 and plan(months).count("FileScan") == 1
    assert scans(gate, "staging/p") == 0
    assert scans(gate, "staging/o") == 1 and plan(passes[0]).count("FileScan") == 1
    assert scans(gate, "curated/f") == 1
    assert not re.search(r"Window \[lead", gate)


def test_key_checks_exchange_loans(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "plan")
    rows = store.write("staging.p", panel.staged_performance(spark, SF))
    text = plan(quality.reduced_months(rows, quality.Expectations({}, {}, panel.WINDOW_END, [])))
    assert [keys.split("#")[0] for keys in exchanges(text)] == ["loan_id"]
    # Below the exchange bitmaps are put together already, and only key columns are read.
    assert re.search(r"partial_bit_or", text[text.index("Exchange") :])
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"loan_id", "as_of_month", "is_on_book_eom"}


def test_row_checks_share_one_pass(spark, tmp_path):
    rows = RunStore(spark, str(tmp_path), "plan").write("staging.p", panel.staged_performance(spark, SF))
    layers = quality.Layers(performance=rows)
    expect = quality.Expectations({}, {}, panel.WINDOW_END, [])
    names = [
        "performance_months_valid", "delinquency_statuses_valid",
        "zero_balance_codes_valid", "on_book_population_consistent",
    ]
    assert plan(quality.failure_counts(layers, expect, names)).count("FileScan") == 1


def test_one_exchange_of_the_panel_serves_join_and_clustering(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), "plan")
    rows = store.write("staging.p", panel.staged_performance(spark, SF))
    dim = store.write("curated.d", curated.dim_loan(panel.staged_origination(spark, SF)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(clustered_panel(rows, dim, 7))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    assert len(exchanges(text)) == 2  # one per side, both by loan into the buckets
    assert all(re.fullmatch(r"loan_id#\d+, 7", keys) for keys in exchanges(text))
    assert text.count("valid_loan_age") == 0  # unused columns stay out of the exchange
