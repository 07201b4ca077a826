import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loanscope.domain import ORIGINATION_FIELDS, PERFORMANCE_FIELDS
from loanscope.operators.quality import DETAILS, Expectations, failure_counts
from loanscope.operators.raw_profile import read_report
from loanscope.operators.staging import stage_origination
from loanscope.plans.build import ValidationFailed, build
from loanscope.plans.dashboard import ExportRejected, check_dashboard, export, load_export
from loanscope.plans.raw_validation import validate_raw
from loanscope.sources import delimited, storage
from loanscope.sources.csv_tables import read_csv, write_csv
from loanscope.testbed import dirty, panel


def origination_line(number, year=2019, **values):
    fields = {
        "loan_id": f"F{year % 100}Q1{number:07d}", "classic_fico": "700", "first_payment_date": f"{year}01",
        "maturity_date": f"{year + 30}01", "original_cltv": "80", "original_dti": "30", "original_upb": "1000",
        "original_ltv": "80", "original_interest_rate": "3.5", "original_loan_term": "360", "vantage_score_4": "700",
    } | values
    return "|".join(fields.get(name, "") for name in ORIGINATION_FIELDS)


def performance_line(number, month, year=2019, **values):
    fields = {
        "loan_id": f"F{year % 100}Q1{number:07d}", "period": month, "current_actual_upb": "900.00",
        "current_loan_delinquency_status": "00", "loan_age": "3",
    } | values
    return "|".join(fields.get(name, "") for name in PERFORMANCE_FIELDS)


def months(first, count):
    year, month = divmod(first, 100)
    return [f"{year + (month - 1 + i) // 12}{(month - 1 + i) % 12 + 1:02d}" for i in range(count)]


@pytest.fixture
def raw(tmp_path):
    """Two vintages of 40 loans with 14 months each."""
    files = {
        f"sample_{year}/sample_{kind}_{year}.txt": lines
        for year in (2019, 2020)
        for kind, lines in (
            ("orig", [origination_line(i, year) for i in range(40)]),
            ("perf", [performance_line(i, m, year, current_loan_delinquency_status=f"{i % 4:02d}")
                      for i in range(40) for m in months(year * 100 + 1, 14)]),
        )
    }
    return files, tmp_path


def write(raw):
    files, folder = raw
    for name, lines in files.items():
        path = folder / "raw" / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder / "raw"), str(folder / "out")


EXPECT = Expectations({2019: 40, 2020: 40}, {2019: 560, 2020: 560}, "2021-02-01", ["2019-06-01", "2020-03-01"])
PERF_2019 = "sample_2019/sample_perf_2019.txt"


def test_missing_files_are_all_listed(spark, raw):
    files, _ = raw
    del files[PERF_2019], files["sample_2020/sample_orig_2020.txt"]
    raw_dir, _ = write(raw)
    with pytest.raises(FileNotFoundError) as error:
        delimited.require_files(spark, raw_dir)
    assert str(error.value).count("sample_") == 4
    assert "sample_perf_2019.txt" in str(error.value) and "sample_orig_2020.txt" in str(error.value)


@pytest.mark.parametrize("line", ["short|row", performance_line(1, "201901") + "|more"])
def test_a_malformed_line_fails_any_read(spark, raw, line):
    raw[0][PERF_2019].append(line)
    raw_dir, _ = write(raw)
    rows = delimited.scan_performance(spark, raw_dir)
    for action in (rows.count, rows.select("loan_id").collect, rows.collect):
        with pytest.raises(PySparkException, match="wrong field count"):
            action()


def test_quoted_pipe_is_part_of_the_field(spark, raw):
    raw[0][PERF_2019].append(performance_line(1, "202101", servicer_name='"A|B"'))
    raw_dir, _ = write(raw)
    rows = delimited.scan_performance(spark, raw_dir)
    assert rows.filter("servicer_name = 'A|B'").count() == 1
    assert {(r.source_year, r.n) for r in rows.groupBy("source_year").agg(F.count("*").alias("n")).collect()} == {
        (2019, 561), (2020, 560),
    }


def test_profile_counts_planted_damage(spark, raw):
    files, _ = raw
    files["sample_2019/sample_orig_2019.txt"] += [
        origination_line(1), origination_line(900, first_payment_date="201913", classic_fico="", original_dti="999"), "x|y",
    ]
    files["sample_2020/sample_orig_2020.txt"].append(origination_line(5))
    files[PERF_2019] += [
        "",
        performance_line(901, "2019-1", current_loan_delinquency_status="", loan_age=""),
        performance_line(3, "202101", zero_balance_code="77", current_loan_delinquency_status="Q1"),
        performance_line(3, "202102", zero_balance_code="77", servicer_name="Café"),
        performance_line(3, "202103", servicer_name='"A|B"'),
    ]
    raw_dir, folder = write(raw)
    expected_rows = {("origination", 2019): 43, ("performance", 2019): 560, ("performance", 2021): 1}
    result = validate_raw(spark, raw_dir, expected_rows, f"{folder}/report")
    found = {(r.dataset, r.source_year, r.metric, r.item): r.value for r in result.profile.collect()}
    expected = {
        ("origination", 2019, "row_count", None): 43,
        ("origination", 2019, "rows_with_wrong_field_count", None): 1,
        ("origination", 2019, "duplicate_loan_ids", None): 1,
        ("origination", 2019, "invalid_required_dates", None): 1,
        ("origination", 2019, "nonnumeric_values_in_numeric_fields", None): 1,
        ("origination", 2019, "missing_important_fields", "classic_fico"): 1,
        ("origination", 2019, "official_sentinel_counts", "original_dti=999"): 1,
        ("origination", None, "cross_vintage_loan_id_overlap", None): 1,
        ("performance", 2019, "row_count", None): 565,
        ("performance", 2019, "rows_with_wrong_field_count", None): 1,
        ("performance", 2019, "rows_with_non_ascii_text", None): 1,
        ("performance", 2019, "invalid_periods", None): 1,
        ("performance", 2019, "nonnumeric_upb_or_loan_age", None): 1,
        ("performance", 2019, "invalid_delinquency_statuses", "<blank>"): 1,
        ("performance", 2019, "invalid_delinquency_statuses", "Q1"): 1,
        ("performance", 2019, "invalid_zero_balance_codes", "77"): 2,
        ("performance", 2019, "min_performance_month", None): 201901,
        ("performance", 2019, "max_performance_month", None): 202103,
        ("performance", 2019, "performance_loans_without_origination", None): 1,
        ("performance", 2019, "originations_without_performance", None): 1,
        ("performance", 2020, "originations_without_performance", None): 1,
    }
    assert expected.items() <= found.items()
    assert not result.passed
    messages = {r.message for r in result.failures.collect()}
    assert "2019 performance: expected 560 rows" in messages
    assert "2021 performance: expected 1 rows" in messages
    assert "2019 performance: invalid_zero_balance_codes=2" in messages
    assert not any("row_count=" in m or "origination: expected" in m for m in messages)
    report = lambda part: read_report(spark, f"{folder}/report", part)
    assert report("failures").count() == len(messages)
    assert report("profile").count() == len(found)
    passed = {(r.dataset, r.source_year): r.passed for r in report("files").collect()}
    assert passed == {("origination", 2019): False, ("origination", 2020): False, ("performance", 2019): False, ("performance", 2020): False}
    assert {(r.dataset, r.expected_fields, r.file.rsplit("/", 1)[1]) for r in report("files").collect()} >= {
        ("origination", 31, "sample_orig_2019.txt"), ("performance", 35, "sample_perf_2020.txt")
    }


def test_codes_without_end_give_a_bounded_profile(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr("loanscope.operators.raw_profile.SHOWN_CODES", 5)
    monkeypatch.setattr("loanscope.operators.raw_profile.TRACKED_CODES", 40)
    files, _ = raw
    files[PERF_2019] += [performance_line(3, "202103", current_loan_delinquency_status=f"S{i}") for i in range(400)]
    files[PERF_2019] += [performance_line(3, "202103", current_loan_delinquency_status="Q7") for _ in range(150)]
    files[PERF_2019] += [performance_line(3, "202103", zero_balance_code=c) for c in ["77", "77", "78", "x" * 5000]]
    raw_dir, _ = write(raw)
    result = validate_raw(spark, raw_dir, {}, str(tmp_path / "report"))
    found = {}
    for row in result.profile.filter("source_year = 2019").collect():
        found.setdefault(row.metric, {})[row.item] = row.value
    statuses = found["invalid_delinquency_statuses"]
    assert len(statuses) <= 6 and statuses["Q7"] == 150 and sum(statuses.values()) == 550
    assert found["invalid_zero_balance_codes"] == {"77": 2, "78": 1, "<other>": 1}
    messages = {r.message for r in result.failures.collect()}
    assert {"2019 performance: invalid_delinquency_statuses=550", "2019 performance: invalid_zero_balance_codes=4"} <= messages
    clean = {r.item: r.value for r in result.profile.filter("source_year = 2020 AND metric = 'invalid_zero_balance_codes'").collect()}
    assert clean == {None: 0}


def test_clean_files_pass_the_raw_validation(spark, raw, tmp_path):
    raw_dir, _ = write(raw)
    expected_rows = {(d, y): n for y in (2019, 2020) for d, n in (("origination", 40), ("performance", 560))}
    for _ in range(2):  # a report is replaced by the next one
        result = validate_raw(spark, raw_dir, expected_rows, str(tmp_path / "report"))
        assert result.passed
    assert read_report(spark, str(tmp_path / "report"), "files").filter("NOT passed").isEmpty()
    found = {(r.dataset, r.source_year, r.metric, r.item): r.value for r in result.profile.collect()}
    for year in (2019, 2020):
        for metric in ("performance_loans_without_origination", "originations_without_performance", "invalid_zero_balance_codes"):
            assert found["performance", year, metric, None] == 0
        assert found["origination", year, "missing_important_fields", "classic_fico"] == 0


@pytest.mark.parametrize("text", ["5F", "1d", "0x1p3", "1_", "--1", "1e"])
def test_numbers_are_decimal(spark, raw, tmp_path, text):
    files, _ = raw
    files["sample_2019/sample_orig_2019.txt"].append(origination_line(950, original_upb=text))
    raw_dir, _ = write(raw)
    result = validate_raw(spark, raw_dir, {}, str(tmp_path / "report"))
    found = {(r.source_year, r.metric): r.value for r in result.failures.collect()}
    assert found[2019, "nonnumeric_values_in_numeric_fields"] == 1 and not result.passed


def test_build_publishes_and_exports(spark, raw, tmp_path):
    raw_dir, root = write(raw)
    report = build(spark, raw_dir, root, EXPECT)
    assert {r.table_name: r.row_count for r in report.row_counts.collect()}["curated.fact_loan_month"] == 1120
    assert tuple(report.summary.first()) == (19, 19)
    assert storage.current_run(spark, root).run_id == report.store.run_id
    assert not spark.catalog.listTables()

    results = export(spark, root, str(tmp_path / "csv"), k=5)
    assert results.filter("NOT passed").isEmpty()
    tables = load_export(spark, str(tmp_path / "csv"))
    assert tables.monthly.count() == 26
    assert dict(tables.segments.dtypes)["on_book_upb"] == "double"
    check_dashboard(tables, 26, "2019-01-01", "2021-02-01")
    with pytest.raises(ExportRejected, match="month count"):
        check_dashboard(tables, 87, "2019-01-01", "2021-02-01")
    with pytest.raises(ValueError):
        export(spark, root, str(tmp_path / "other"), k=1)
    for name, key in (
        ("mart.portfolio_monthly", ["as_of_month"]),
        ("mart.portfolio_monthly_by_segment", ["as_of_month", "segment_name", "segment_value"]),
        ("mart.delinquency_transition_monthly", ["from_month", "segment_name", "segment_value", "from_state", "to_state"]),
    ):
        rows = [tuple(r) for r in report.store.read(name).select(*key).collect()]
        assert rows == sorted(rows)


def test_an_export_is_replaced_as_a_whole(spark, raw, tmp_path, monkeypatch):
    raw_dir, root = write(raw)
    build(spark, raw_dir, root, EXPECT)
    out = str(tmp_path / "csv")
    export(spark, root, out, k=5)
    first = storage.current_version(spark, out)
    export(spark, root, out, k=10)
    second = storage.current_version(spark, out)
    assert second != first and load_export(spark, out).monthly.count() == 26

    def broken(table, path):
        if path.endswith("delinquency_transition_monthly"):
            raise OSError("disk full")
        write_csv(table, path)

    monkeypatch.setattr("loanscope.plans.dashboard.write_csv", broken)
    with pytest.raises(OSError):
        export(spark, root, out, k=5)
    assert storage.current_version(spark, out) == second
    assert load_export(spark, out).monthly.count() == 26
    with pytest.raises(FileNotFoundError):
        load_export(spark, str(tmp_path / "none"))


def test_an_export_is_judged_before_it_counts(spark, raw, tmp_path, monkeypatch):
    raw_dir, root = write(raw)
    build(spark, raw_dir, root, EXPECT)
    out = str(tmp_path / "csv")
    results = export(spark, root, out, k=5)
    assert {"transitions not empty", "month count", "portfolio_monthly stored"} <= {r.check_name for r in results.collect()}
    first = storage.current_version(spark, out)
    rows = load_export(spark, out).transitions.collect()
    # No cohort has so many loans, so nothing would be left of the transitions.
    with pytest.raises(ExportRejected, match="transitions not empty"):
        export(spark, root, out, k=1000)

    def losing(table, path):
        write_csv(table.limit(3) if path.endswith("by_segment") else table, path)

    monkeypatch.setattr("loanscope.plans.dashboard.write_csv", losing)
    with pytest.raises(ExportRejected, match="portfolio_monthly_by_segment stored"):
        export(spark, root, out, k=5)
    assert storage.current_version(spark, out) == first
    assert load_export(spark, out).transitions.collect() == rows
    assert os.listdir(f"{out}/versions") == [first]
    assert not os.listdir(f"{out}/leases/{first}")


def test_a_vintage_that_disagrees_with_its_file_rejects_the_build(spark, raw):
    files, _ = raw
    for name in ("sample_2019/sample_orig_2019.txt", PERF_2019):
        files[name] = [line.replace("F19Q10000003", "F20Q19999999") for line in files[name]]
    raw_dir, root = write(raw)
    with pytest.raises(ValidationFailed) as error:
        build(spark, raw_dir, root, EXPECT)
    assert {name: count for name, count, _ in error.value.failures} == {"vintage_matches_file_year": 1}
    assert storage.current_run(spark, root) is None


@pytest.mark.parametrize("ansi", [True, False])
def test_bad_text_raises_with_and_without_ansi(spark, tmp_path, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        columns = ", ".join(f"'' AS {f}" for f in ORIGINATION_FIELDS if f != "loan_id")
        rows = spark.sql(f"SELECT 2019S AS source_year, 'f' AS source_file, 'FxxQ10000001' AS loan_id, {columns}")
        with pytest.raises(Exception, match="no vintage in loan id"):
            stage_origination(rows).collect()
        path = str(tmp_path / f"csv{ansi}")
        spark.sql("SELECT 'x' AS as_of_month, '1' AS on_book_upb").write.option("header", True).csv(path)
        with pytest.raises(Exception, match="as_of_month is no date"):
            read_csv(spark, path, ["as_of_month", "on_book_upb"]).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_long_loan_numbers_stay_apart(spark):
    ids = spark.sql("SELECT * FROM VALUES (12345670L), (12345678L), (12L) AS t(k)").selectExpr(f"{panel._LOAN_ID} AS loan_id")
    assert {r.loan_id for r in ids.collect()} == {"F19Q312345670", "F19Q312345678", "F19Q10000012"}


@pytest.mark.parametrize("repeat", [False, True])
def test_a_failed_build_leaves_the_published_version(spark, raw, repeat):
    raw_dir, root = write(raw)
    first = build(spark, raw_dir, root, EXPECT).store
    files, _ = raw
    files[PERF_2019][0] = performance_line(0, "201901", current_loan_delinquency_status="A1")
    if repeat:
        files[PERF_2019][1] = files[PERF_2019][2]
    write(raw)
    with pytest.raises(ValidationFailed) as error:
        build(spark, raw_dir, root, EXPECT)
    failed = {name: count for name, count, _ in error.value.failures}
    store = error.value.store
    # A rejected run keeps its report. A repeated key ends the build before the panel.
    if repeat:
        assert failed == {"performance_loan_month_unique": 1}
        assert store.read("quality.key_checks").count() == 2
        assert not os.path.exists(store.table_path("curated.fact_loan_month"))
    else:
        assert failed == {"delinquency_statuses_valid": 1}
        assert store.read("quality.validation_results").count() == 19
    assert storage.current_run(spark, root).run_id == first.run_id
    assert not spark.catalog.listTables()


def test_every_check_finds_something_on_the_dirty_panel(spark):
    expect = Expectations({2019: 1}, {2019: 1}, "2025-11-01", ["2020-06-01", "2021-06-01"])
    counts = failure_counts(dirty.layers(spark, "/root/testdata/sf0.01"), expect)
    found = {r.check_name: r.failed_row_count for r in counts.collect()}
    assert set(found) == set(DETAILS)
    assert min(found.values()) > 0


def test_csv_refuses_identifiers_and_reports_missing_columns(spark, tmp_path):
    table = spark.createDataFrame([("x", 1)], "first_Loan_Id string, n int")
    with pytest.raises(ValueError, match="identifiers"):
        write_csv(table, str(tmp_path / "a"))
    write_csv(table.select("n"), str(tmp_path / "b"))
    with pytest.raises(ValueError, match="on_book_upb"):
        read_csv(spark, str(tmp_path / "b"), ["n", "on_book_upb"])


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf(**{"spark.master": "yarn"})
        sparkContext = type("Context", (), {"_jsc": None})

    with pytest.raises(RuntimeError):
        storage.scratch_dir(Session, "x")
    Session.conf = Conf(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert storage.scratch_dir(Session, "x").startswith("hdfs:///shared/loanscope-x-")
