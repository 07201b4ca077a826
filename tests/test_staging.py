import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loanscope.domain import ORIGINATION_FIELDS, PERFORMANCE_FIELDS
from loanscope.operators.curated import dim_loan
from loanscope.operators.staging import stage_origination, stage_performance
from tests.helpers import performance


def raw(spark, fields, **values):
    row = {name: values.get(name, "") for name in fields}
    return spark.createDataFrame([row], ", ".join(f"{f} string" for f in fields)).withColumns(
        {"source_year": F.lit(2019).cast("smallint"), "source_file": F.lit("f")}
    )


@pytest.mark.parametrize(
    "upb, status, age, code, state",
    [
        ("100", "00", 5, "01", "TERMINATED:01"),
        ("0", "00", None, "96", "TERMINATED:96"),
        ("100", "00", None, None, "UNKNOWN_LOAN_AGE"),
        ("100", "RA", None, None, "UNKNOWN_LOAN_AGE"),
        ("100", "00", -1, None, "UNKNOWN_LOAN_AGE"),
        ("100", "00", 0, None, "PRE_DUE"),
        ("100", "01", 0, None, "30"),
        ("100", "XX", 0, None, "UNKNOWN"),
        ("100", "00", 1, None, "CURRENT"),
        ("100", "01", 1, None, "30"),
        ("100", "02", 1, None, "60"),
        ("100", "03", 1, None, "90+"),
        ("100", "99", 1, None, "90+"),
        ("100", "RA", 1, None, "REO_ACQUISITION"),
        ("100", "XX", 1, None, "UNKNOWN"),
        ("100", None, 1, None, "UNKNOWN"),
        ("100", "A1", 1, None, "UNKNOWN"),
    ],
)
def test_monitoring_state(spark, upb, status, age, code, state):
    row = performance(spark, [("F19Q10000001", "2020-01-01", upb, status, age, code)]).first()
    assert row.monitoring_state == state


def test_flags_follow_three_valued_logic(spark):
    rows = [
        ("a", "2020-01-01", None, "00", 1, None),
        ("b", "2020-01-01", None, "00", 1, "01"),
        ("c", "2020-01-01", "0", "00", 1, None),
        ("d", "2020-01-01", "5", "00", None, None),
        ("e", "2020-01-01", "5", "00", -1, None),
        ("f", "2020-01-01", "5", "00", 1, None),
    ]
    flags = {
        r.loan_id: (r.is_on_book_eom, r.is_delinquency_eligible, r.is_valid_loan_age)
        for r in performance(spark, rows).collect()
    }
    assert flags == {
        "a": (None, None, True),
        "b": (False, False, True),
        "c": (False, False, True),
        "d": (True, None, False),
        "e": (True, False, False),
        "f": (True, True, True),
    }


def test_origination_has_all_columns_and_keeps_raw_text(spark):
    staged = stage_origination(
        raw(spark, ORIGINATION_FIELDS, loan_id="F20Q30000001", classic_fico="9999", original_cltv="999", original_upb="1000.5")
    )
    assert len(staged.columns) == 45
    row = staged.first()
    assert (row.origination_year, row.origination_quarter) == (2020, "Q3")
    assert (row.classic_fico, row.classic_fico_raw, row.classic_fico_missing_reason) == (None, "9999", "NOT_AVAILABLE")
    assert (row.original_cltv, row.vantage_score_4_missing_reason) == (None, "BLANK")
    assert str(row.original_upb) == "1000.50"
    assert row.channel is None


def test_performance_has_all_columns(spark):
    staged = stage_performance(
        raw(spark, PERFORMANCE_FIELDS, loan_id="F20Q30000001", period="202003", current_actual_upb="10",
            current_loan_delinquency_status="01", loan_age="2", bankruptcy_cramdown_costs="3")
    )
    assert len(staged.columns) == 50
    row = staged.first()
    assert row.monitoring_state == "30"
    assert row.dq_cramdown_populated_non_terminal is True
    assert row.period_raw == "202003"


def test_malformed_loan_id_raises(spark):
    staged = stage_origination(raw(spark, ORIGINATION_FIELDS, loan_id="FxxQ10000001"))
    with pytest.raises(PySparkException):
        staged.collect()


@pytest.mark.parametrize(
    "field, band, edges",
    [
        ("classic_fico", "fico_band", {619: "<620", 620: "620-659", 659: "620-659", 660: "660-699", 699: "660-699",
                                       700: "700-739", 739: "700-739", 740: "740-779", 779: "740-779", 780: "780+", None: "Unknown"}),
        ("original_cltv", "cltv_band", {60: "<=60", 61: "61-70", 70: "61-70", 71: "71-80", 80: "71-80", 81: "81-90",
                                        90: "81-90", 91: "91-95", 95: "91-95", 96: ">95", None: "Unknown"}),
        ("original_dti", "dti_band", {20: "<=20", 21: "21-30", 30: "21-30", 31: "31-40", 40: "31-40", 41: "41-45",
                                      45: "41-45", 46: "46-50", 50: "46-50", 51: ">50", None: "Unknown"}),
    ],
)
def test_band_edges(spark, field, band, edges):
    staged = stage_origination(raw(spark, ORIGINATION_FIELDS, loan_id="F19Q10000001"))
    values = spark.createDataFrame([(v,) for v in edges], "v smallint")
    rows = staged.drop(field).join(values.withColumnRenamed("v", field))
    assert {r[field]: r[band] for r in dim_loan(rows).collect()} == edges
