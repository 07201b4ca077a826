"""Tables that several steps read are derived once: what reads them scans a stored copy."""

import pytest
from pyspark.sql import functions as F

from loanscope.operators.quality import Expectations, failure_counts
from loanscope.sources.records import multi_line_records, split_lines
from loanscope.testbed import dirty, panel, registry
from tests.test_blank_amounts import plan

LINEITEM = "l_orderkey long, l_partkey long, l_extendedprice double, l_shipdate timestamp_ntz"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two orders of loan 2, an order that comes twice, and one order without a customer."""
    folder = str(tmp_path_factory.mktemp("tables"))
    lines = [(o, 7 * o + i, 10.5 + i, f"1996-0{1 + i}-15") for o in (1, 2, 3, 4) for i in range(5)]
    raw = spark.createDataFrame(lines, "o long, p long, x double, d string")
    raw.selectExpr("o AS l_orderkey", "p AS l_partkey", "x AS l_extendedprice", "cast(d AS timestamp_ntz) AS l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, 2), (2, 2), (3, 4), (3, 4), (4, None)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(2,), (4,), (6,)], "c_custkey long").write.parquet(f"{folder}/customer.parquet")
    return folder


def test_expected_rows_are_distinct_months_and_loans(spark, tables):
    assert panel.expected_rows(spark, tables) == {"origination": {2019: 2}, "performance": {2019: 10}}
    rows = panel.performance(spark, tables)
    assert rows.count() == 10 and panel.raw_origination(spark, tables).count() == 2


def test_dirty_layers_and_checks_read_stored_tables(spark, tables):
    layers = dirty.layers(spark, tables)
    expect = Expectations({2019: 2}, {2019: 10}, panel.WINDOW_END, panel.SPOT_MONTHS)
    for table in (layers.performance, layers.fact, layers.pairs, layers.segments, failure_counts(layers, expect)):
        assert "lineitem" not in plan(table)


def test_export_checks_read_stored_marts(spark, tables):
    assert "lineitem" not in plan(registry._export_report(spark, tables, tampered=True))


def test_raw_files_are_written_from_lines_put_together_once(spark, tables, monkeypatch):
    stored = []
    keep = registry.storage.written
    monkeypatch.setattr(registry.storage, "written", lambda t, path: stored.append(t.columns) or keep(t, path))
    folder = registry._raw_files(spark, tables)
    assert stored == [["source_year", "value"]] * 2
    assert spark.read.text(f"{folder}/sample_2019/sample_perf_2019.txt").count() == 10


@pytest.mark.parametrize("size", [1, 2, 1000])
def test_blocks_are_cut_and_whole_lines_are_not_gathered(spark, tmp_path, size):
    text = "\n".join(['a|b', '', 'c|"d', '', 'e"|f', 'g|"h"', 'i|"j', 'k"', 'l|m'])
    (tmp_path / "a.txt").write_text(text + "\n")
    lines = split_lines(spark, [str(tmp_path / "a.txt")], size)
    assert lines.groupBy("source_file", "block").count().agg(F.max("count")).first()[0] <= size
    records = multi_line_records(lines)
    assert sorted(r.value for r in records.collect()) == sorted(['a|b', '', 'c|"d\n\ne"|f', 'g|"h"', 'i|"j\nk"', 'l|m'])
    assert "Union" in plan(records)
