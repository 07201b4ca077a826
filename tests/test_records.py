"""Records with quoted line feeds against the csv module, on split files and odd quotes."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from loanscope.plans.build import build
from loanscope.plans.raw_validation import validate_raw
from loanscope.sources.delimited import scan, scan_lines
from loanscope.sources.records import (
    files_with_open_lines,
    multi_line_records,
    split_lines,
)
from tests.test_files_and_build import EXPECT, PERF_2019, performance_line, raw, write  # noqa: F401


def read_by_module(text):
    rows = csv.reader(io.StringIO(text, newline=""), delimiter="|")
    return sorted(tuple(v.replace("\r\n", "\n") for v in row) for row in rows)


def split_by_module(values):
    return sorted(tuple(row) for value in values for row in csv.reader(io.StringIO(value, newline=""), delimiter="|"))


def as_blocks(spark, text, draw, longest):
    """Lines of a file in blocks of random length; places say nothing about the order of blocks."""
    lines = text.split("\n")
    starts = [0]
    while starts[-1] < len(lines):
        starts.append(starts[-1] + draw.randint(1, longest))
    numbers = list(range(len(starts)))
    draw.shuffle(numbers)
    rows = [
        ("f", 1000 * b, 10_000 * numbers[b] + i, line)
        for b, (low, high) in enumerate(zip(starts, starts[1:]))
        for i, line in enumerate(lines[low:high])
    ]
    return spark.createDataFrame(rows, "source_file string, block long, place long, value string")


@pytest.mark.parametrize("seed", range(6))
def test_same_records_as_the_csv_module(spark, seed):
    draw = random.Random(seed)
    pieces = ['"', '"', '""', "|", "a", "bc", "\n", "\n", '|"', '"|', "|x|", '"q"']
    text = "".join(draw.choice(pieces) for _ in range(400)) + "end"
    for longest in (1, 3, 500):
        lines = as_blocks(spark, text, draw, longest)
        found = [r.value for r in multi_line_records(lines).collect()]
        # Empty records have no row in the module and are empty lines here.
        assert split_by_module(v for v in found if v) == [r for r in read_by_module(text) if r]


def test_files_are_split_and_only_open_ones_are_joined(spark, tmp_path):
    folder = tmp_path / "sample_2019"
    folder.mkdir()
    draw = random.Random(7)
    open_text = "".join(
        f'{i}|"a{chr(10)}b ""{i}""{chr(10)}"|x{i}\n' if draw.random() < 0.3 else f'{i}|"plain|{i}"|y\n' for i in range(3000)
    )
    plain_text = "".join(f'{i}|say "{i}|z\n' for i in range(3000))
    (folder / "open.txt").write_text(open_text)
    (folder / "plain.txt").write_text(plain_text)
    former = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        names = files_with_open_lines(spark, str(folder))
        assert [n.rsplit("/", 1)[1] for n in names] == ["open.txt"]
        lines = split_lines(spark, names)
        assert lines.select("block").distinct().count() == -(-len(open_text) // 4096)
        assert lines.rdd.getNumPartitions() > 15
        found = scan_lines(spark, str(folder))
        plans = found._jdf.queryExecution().toString()
        assert "MapInPandas" not in plans and "PythonUDF" not in plans
        rows = found.collect()
        records = [r.value for r in rows if r.source_file.endswith("open.txt")]
        assert split_by_module(records) == read_by_module(open_text) and len(records) == 3000
        assert len(rows) == 6000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", former)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_quote_that_is_never_closed(spark, tmp_path):
    folder = tmp_path / "sample_2019"
    folder.mkdir()
    (folder / "a.txt").write_text('1|"x\n2|y\n3|z\n')
    assert [r.value for r in scan_lines(spark, str(folder)).collect()] == ['1|"x\n2|y\n3|z']
    lines = split_lines(spark, [str(folder / "a.txt")])
    with pytest.raises(ValueError, match="stays open"):
        multi_line_records(lines, longest=8)
    (folder / "a.txt").write_text("")
    assert scan_lines(spark, str(folder)).collect() == []


def test_staging_and_profile_give_one_row_for_such_a_record(spark, raw, tmp_path):  # noqa: F811
    files, _ = raw
    files[PERF_2019][0] = performance_line(0, "201901", servicer_name='"A\n\nB|""C"""')
    raw_dir, root = write(raw)
    rows = scan(spark, raw_dir, "performance").filter(F.col("servicer_name").contains("\n")).collect()
    assert [r.servicer_name for r in rows] == ['A\n\nB|"C"'] and rows[0].loan_id
    assert scan(spark, raw_dir, "performance").count() == 1120
    expected_rows = {(d, y): n for y in (2019, 2020) for d, n in (("origination", 40), ("performance", 560))}
    assert validate_raw(spark, raw_dir, expected_rows, str(tmp_path / "report")).passed
    report = build(spark, raw_dir, root, EXPECT)
    assert {r.table_name: r.row_count for r in report.row_counts.collect()}["staging.monthly_performance"] == 1120
