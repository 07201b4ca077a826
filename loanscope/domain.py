"""Fixed vocabulary of the loan-performance domain.

Everything in this module is a fixed value: file layouts, code lists, labels
and band edges that results depend on. No logic lives here.
"""

from __future__ import annotations

# --- fixed file layouts, in file order ---------------------------------------

ORIGINATION_FIELDS = [
    "classic_fico",
    "first_payment_date",
    "first_time_homebuyer_indicator",
    "maturity_date",
    "msa_or_metropolitan_division",
    "mi_percentage",
    "number_of_units",
    "occupancy_status",
    "original_cltv",
    "original_dti",
    "original_upb",
    "original_ltv",
    "original_interest_rate",
    "channel",
    "prepayment_penalty_indicator",
    "amortization_type",
    "property_state",
    "property_type",
    "postal_code",
    "loan_id",
    "loan_purpose",
    "original_loan_term",
    "number_of_borrowers",
    "seller_name",
    "super_conforming_flag",
    "pre_harp_loan_id",
    "special_eligibility_program",
    "harp_indicator",
    "property_valuation_method",
    "interest_only_indicator",
    "vantage_score_4",
]

PERFORMANCE_FIELDS = [
    "loan_id",
    "period",
    "current_actual_upb",
    "current_loan_delinquency_status",
    "loan_age",
    "remaining_months_to_legal_maturity",
    "defect_settlement_date",
    "modification_flag",
    "zero_balance_code",
    "zero_balance_effective_date",
    "current_interest_rate",
    "current_non_interest_bearing_upb",
    "ddlpi",
    "mi_recoveries",
    "net_sales_proceeds",
    "non_mi_recoveries",
    "total_expenses",
    "legal_costs",
    "maintenance_and_preservation_costs",
    "taxes_and_insurance",
    "miscellaneous_expenses",
    "actual_loss",
    "cumulative_modification_costs",
    "interest_rate_step_indicator",
    "payment_deferral_flag",
    "estimated_ltv",
    "zero_balance_removal_upb",
    "delinquent_accrued_interest",
    "delinquency_due_to_disaster",
    "borrower_assistance_plan",
    "current_period_modification_costs",
    "current_interest_bearing_upb",
    "mi_cancellation_indicator",
    "servicer_name",
    "bankruptcy_cramdown_costs",
]

# --- fixed code lists ---------------------------------------------------------

ZERO_BALANCE_CODES = ["01", "02", "03", "09", "15", "16", "96"]
NON_NUMERIC_STATUSES = ["RA", "XX"]
SCORE_MISSING = "9999"
PERCENT_MISSING = "999"

# --- fixed monitoring states and their display order --------------------------

OPEN_STATES = [
    "PRE_DUE",
    "CURRENT",
    "30",
    "60",
    "90+",
    "REO_ACQUISITION",
    "UNKNOWN_LOAN_AGE",
    "UNKNOWN",
]
TERMINATED_PREFIX = "TERMINATED:"
OTHER_DESTINATION = "OTHER_OR_LOW_VOLUME"
DESTINATION_STATES = [
    "PRE_DUE",
    "CURRENT",
    "30",
    "60",
    "90+",
    "REO_ACQUISITION",
    "TERMINATED:01",
    "TERMINATED:02",
    "TERMINATED:03",
    "TERMINATED:09",
    "TERMINATED:15",
    "TERMINATED:16",
    "TERMINATED:96",
    "UNKNOWN_LOAN_AGE",
    "UNKNOWN",
    "OTHER_OR_LOW_VOLUME",
]
STATE_ORDER = {
    "PRE_DUE": 0,
    "CURRENT": 1,
    "30": 2,
    "60": 3,
    "90+": 4,
    "REO_ACQUISITION": 5,
    "UNKNOWN_LOAN_AGE": 97,
    "UNKNOWN": 98,
}
TERMINATED_ORDER = 6
OTHER_DESTINATION_ORDER = 99

# --- fixed risk bands: (largest value in the band, label) ---------------------

FICO_BANDS = [
    (619, "<620"),
    (659, "620-659"),
    (699, "660-699"),
    (739, "700-739"),
    (779, "740-779"),
    (None, "780+"),
]
CLTV_BANDS = [
    (60, "<=60"),
    (70, "61-70"),
    (80, "71-80"),
    (90, "81-90"),
    (95, "91-95"),
    (None, ">95"),
]
DTI_BANDS = [
    (20, "<=20"),
    (30, "21-30"),
    (40, "31-40"),
    (45, "41-45"),
    (50, "46-50"),
    (None, ">50"),
]
UNKNOWN_BAND = "Unknown"
OTHER_SEGMENT = "Other / low volume"

# segment name -> column of the loan-month panel that holds its value
SEGMENTS = {
    "origination_year": "origination_year",
    "classic_fico": "fico_band",
    "original_cltv": "cltv_band",
    "original_dti": "dti_band",
}
SEGMENT_BANDS = {
    "classic_fico": [label for _, label in FICO_BANDS] + [UNKNOWN_BAND],
    "original_cltv": [label for _, label in CLTV_BANDS] + [UNKNOWN_BAND],
    "original_dti": [label for _, label in DTI_BANDS] + [UNKNOWN_BAND],
}
UNRANKED_SEGMENT_ORDER = 99

# --- fixed defaults -----------------------------------------------------------

VINTAGES = (2019, 2020)
MIN_CELL_COUNT = 20
