"""Tasks stay small however large the tables are, and generated code is compiled."""

import pytest

from loanscope.operators.curated import weighted_pairs
from loanscope.sources import storage
from loanscope.testbed import dirty, panel, registry
from tests.helpers import rows_of
from tests.test_derived_once import tables  # noqa: F401


def test_partitions_follow_the_lines(spark, tables, monkeypatch):  # noqa: F811
    assert panel.partitions(spark, tables) is None
    few = rows_of(dirty.pairs(spark, tables))
    loans = rows_of(panel.raw_origination(spark, tables))
    expected = panel.expected_rows(spark, tables)
    monkeypatch.setattr(panel, "LINES_OF_PARTITION", 1)
    assert panel.partitions(spark, tables) == 20
    pairs = dirty.pairs(spark, tables)
    assert pairs.rdd.getNumPartitions() == 20
    assert panel.performance(spark, tables).rdd.getNumPartitions() == 20
    assert rows_of(pairs) == few and rows_of(panel.raw_origination(spark, tables)) == loans
    assert panel.expected_rows(spark, tables) == expected


def test_pairs_are_the_same_in_any_number_of_partitions(spark, tables):  # noqa: F811
    rows = panel.fact(spark, tables)
    assert rows_of(weighted_pairs(rows.unionByName(rows), 7)) == rows_of(weighted_pairs(rows.unionByName(rows)))
    assert weighted_pairs(rows, 7).rdd.getNumPartitions() == 7


def test_raw_origination_lines_are_of_the_observed_loans(spark, tables):  # noqa: F811
    spoiled = registry._raw_files(spark, tables, lambda lines: lines)
    plain = registry._raw_files(spark, tables)
    files = [f"{folder}/sample_2019/sample_orig_2019.txt" for folder in (spoiled, plain)]
    lines = [sorted(r.value for r in spark.read.text(path).collect()) for path in files]
    assert lines[0] == lines[1] and len(lines[0]) == 2


@pytest.mark.parametrize("before", [None, "65535", "500"])
def test_long_methods_are_left_out_while_tables_are_written(spark, before, tmp_path, monkeypatch):
    limit = "spark.sql.codegen.hugeMethodLimit"
    default = spark.conf.get(limit)
    if before is not None:
        spark.conf.set(limit, before)
    try:
        with storage.compiled_methods(spark):
            with storage.compiled_methods(spark):
                assert int(spark.conf.get(limit)) <= storage.JIT_METHOD_BYTES
            assert int(spark.conf.get(limit)) <= storage.JIT_METHOD_BYTES
        assert spark.conf.get(limit) == (before or default)
        seen = []
        keep = storage.compiled_methods
        monkeypatch.setattr(storage, "compiled_methods", lambda s: seen.append(1) or keep(s))
        assert storage.written(spark.range(3), str(tmp_path / "t")).count() == 3 and seen == [1]
    finally:
        spark.conf.unset(limit)
