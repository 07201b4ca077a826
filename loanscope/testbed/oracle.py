"""SQL over the test tables that states what each query must return.

The statements are plain SQL for an embedded analytical database and share no
expressions with the operators. Every statement is assembled from named building blocks
(common table expressions); only the blocks a statement mentions are included.
Amounts are exact decimals inside and doubles in the result.
"""

from __future__ import annotations

import re

# --- the derived panel --------------------------------------------------------

_PANEL = {
    "shipped": """
        select o_custkey as k,
               cast(date_trunc('month', cast(l_shipdate as date)) + interval '24' year as date) as m,
               min(l_partkey) as mp,
               sum(cast(l_extendedprice as decimal(18,2))) as amount
        from lineitem join orders on o_orderkey = l_orderkey
        group by 1, 2""",
    "kept": """
        select *, 2019 + k % 2 as v,
               'F' || ((2019 + k % 2) % 100) || 'Q' || (1 + k % 4)
                   || printf('%07d', k) as loan_id
        from shipped
        where m >= make_date(cast(2019 + k % 2 as int), 1, 1)""",
    "panel": """
        select k, mp, cast(v as smallint) as source_year, loan_id, m as as_of_month,
               cast(case when mp % 101 = 0 then 0 else amount end as decimal(18,2))
                   as current_actual_upb,
               case when mp % 37 = 0 then 'XX'
                    when mp % 41 = 0 then 'RA'
                    when mp % 3 = 0
                    then lpad(cast(cast(floor(mp / 3) as int) % 6 as varchar), 2, '0')
                    else '00' end as delinquency_status_raw,
               case when mp % 89 = 0 then null
                    else cast(date_diff('month', min(m) over (partition by k), m) as smallint)
                    end as loan_age,
               case when mp % 29 = 0
                    then ['01', '02', '03', '09', '15', '16', '96'][1 + mp % 7]
                    end as zero_balance_code,
               case when mp % 29 = 0 then m end as zero_balance_effective_month
        from kept""",
    "loans": "select distinct k, source_year, loan_id from panel",
    "orig_text": """
        select k, source_year, loan_id,
               case when k % 97 = 0 then '9999' when k % 89 = 0 then ''
                    else cast(560 + k * 37 % 291 as varchar) end as classic_fico,
               cast(source_year as varchar) || lpad(cast(k % 12 + 1 as varchar), 2, '0')
                   as first_payment_date,
               if(k % 5 = 0, 'Y', 'N') as first_time_homebuyer_indicator,
               cast(source_year + 30 as varchar) || lpad(cast(k % 12 + 1 as varchar), 2, '0')
                   as maturity_date,
               if(k % 13 = 0, '', cast(10180 + k % 900 * 37 as varchar))
                   as msa_or_metropolitan_division,
               if(k % 61 = 0, '999', cast(k % 4 * 6 as varchar)) as mi_percentage,
               cast(k % 4 + 1 as varchar) as number_of_units,
               case when k % 7 = 0 then 'S' when k % 11 = 0 then 'I' else 'P' end
                   as occupancy_status,
               if(k % 83 = 0, '999', cast(35 + k * 53 % 66 as varchar)) as original_cltv,
               if(k % 71 = 0, '999', cast(5 + k * 29 % 61 as varchar)) as original_dti,
               cast(50000 + k * 7919 % 500000 as varchar) as original_upb,
               if(k % 79 = 0, '999', cast(30 + k * 53 % 66 as varchar)) as original_ltv,
               cast(k % 4 + 2 as varchar) || '.' || lpad(cast(k % 1000 as varchar), 3, '0')
                   as original_interest_rate,
               ['R', 'B', 'C'][1 + k % 3] as channel,
               if(k % 53 = 0, null, 'N') as prepayment_penalty_indicator,
               'FRM' as amortization_type,
               if(k % 2 = 0, 'CA', 'TX') as property_state,
               if(k % 6 = 0, 'CO', 'SF') as property_type,
               lpad(cast(k % 1000 as varchar), 3, '0') || '00' as postal_code,
               if(k % 4 = 0, 'C', 'P') as loan_purpose,
               if(k % 6 = 0, '180', '360') as original_loan_term,
               cast(k % 2 + 1 as varchar) as number_of_borrowers,
               'Seller ' || (k % 20) as seller_name,
               if(k % 43 = 0, '9999', cast(540 + k * 31 % 301 as varchar)) as vantage_score_4,
               if(k % 17 = 0, 'Y', '') as super_conforming_flag,
               if(k % 19 = 0, 'F99Q1' || (k % 1000), '') as pre_harp_loan_id,
               if(k % 23 = 0, 'H', '') as special_eligibility_program,
               if(k % 29 = 0, 'Y', '') as harp_indicator,
               cast(k % 3 + 1 as varchar) as property_valuation_method,
               if(k % 31 = 0, 'Y', 'N') as interest_only_indicator
        from loans""",
}

# --- staging ------------------------------------------------------------------

_PERF_FLAGS = """
    select *,
           zero_balance_code is not null as is_terminal_record,
           zero_balance_code is null and current_actual_upb > 0 as is_on_book_eom,
           delinquency_months is not null as is_numeric_delinquency_status,
           coalesce(loan_age >= 0, false) as is_valid_loan_age,
           zero_balance_code is null and current_actual_upb > 0
               and delinquency_months is not null and loan_age >= 1 as is_delinquency_eligible,
           case when zero_balance_code is not null then concat('TERMINATED:', zero_balance_code)
                when coalesce(loan_age, -1) < 0 then 'UNKNOWN_LOAN_AGE'
                when delinquency_months = 0 then if(loan_age = 0, 'PRE_DUE', 'CURRENT')
                when delinquency_months = 1 then '30'
                when delinquency_months = 2 then '60'
                when delinquency_months is not null then '90+'
                when delinquency_status_raw = 'RA' then 'REO_ACQUISITION'
                else 'UNKNOWN' end as monitoring_state
    from {source}"""

TWO_DIGITS = "regexp_full_match(delinquency_status_raw, '[0-9][0-9]')"

_STAGING = {
    "perf_typed": f"""
        select *, if({TWO_DIGITS}, try_cast(delinquency_status_raw as smallint), null)
                   as delinquency_months
        from panel""",
    "perf": _PERF_FLAGS.format(source="perf_typed"),
    "orig": """
        select loan_id, source_year,
               cast(2000 + cast(loan_id[2:3] as int) as smallint) as origination_year,
               loan_id[4:5] as origination_quarter,
               classic_fico as classic_fico_raw,
               try_cast(nullif(classic_fico, '9999') as smallint) as classic_fico,
               case classic_fico when '9999' then 'NOT_AVAILABLE' when '' then 'BLANK' end
                   as classic_fico_missing_reason,
               first_payment_date as first_payment_date_raw,
               cast(try_strptime(first_payment_date, '%Y%m') as date) as first_payment_month,
               first_time_homebuyer_indicator,
               maturity_date as maturity_date_raw,
               cast(try_strptime(maturity_date, '%Y%m') as date) as maturity_month,
               try_cast(msa_or_metropolitan_division as integer) as msa_or_metropolitan_division,
               mi_percentage as mi_percentage_raw,
               try_cast(nullif(mi_percentage, '999') as smallint) as mi_percentage,
               try_cast(number_of_units as smallint) as number_of_units,
               occupancy_status,
               original_cltv as original_cltv_raw,
               try_cast(nullif(original_cltv, '999') as smallint) as original_cltv,
               original_dti as original_dti_raw,
               try_cast(nullif(original_dti, '999') as smallint) as original_dti,
               try_cast(original_upb as decimal(18,2)) as original_upb,
               original_ltv as original_ltv_raw,
               try_cast(nullif(original_ltv, '999') as smallint) as original_ltv,
               try_cast(original_interest_rate as decimal(9,3)) as original_interest_rate,
               channel, prepayment_penalty_indicator, amortization_type, property_state,
               property_type, postal_code, loan_purpose,
               try_cast(original_loan_term as smallint) as original_loan_term,
               try_cast(number_of_borrowers as smallint) as number_of_borrowers,
               seller_name,
               vantage_score_4 as vantage_score_4_raw,
               try_cast(nullif(vantage_score_4, '9999') as smallint) as vantage_score_4,
               if(vantage_score_4 = '9999', 'NOT_AVAILABLE', null)
                   as vantage_score_4_missing_reason
        from orig_text""",
}

# --- curated ------------------------------------------------------------------


def _band(column: str, edges: list[int], labels: list[str]) -> str:
    arms = " ".join(
        f"when {column} < {edge} then '{label}'" for edge, label in zip(edges, labels)
    )
    return f"case when {column} is null then 'Unknown' {arms} else '{labels[-1]}' end"


_FICO = _band(
    "classic_fico",
    [620, 660, 700, 740, 780],
    ["<620", "620-659", "660-699", "700-739", "740-779", "780+"],
)
_CLTV = _band(
    "original_cltv",
    [61, 71, 81, 91, 96],
    ["<=60", "61-70", "71-80", "81-90", "91-95", ">95"],
)
_DTI = _band(
    "original_dti",
    [21, 31, 41, 46, 51],
    ["<=20", "21-30", "31-40", "41-45", "46-50", ">50"],
)

_CURATED = {
    "dim": f"""
        select *, {_FICO} as fico_band, {_CLTV} as cltv_band, {_DTI} as dti_band from orig""",
    "fact": """
        select perf.*, dim.origination_year, dim.origination_quarter,
               dim.fico_band, dim.cltv_band, dim.dti_band
        from perf, dim where perf.loan_id = dim.loan_id""",
    "pairs_joined": """
        select a.loan_id, a.as_of_month as from_month, b.as_of_month as to_month,
               a.origination_year, a.fico_band, a.cltv_band, a.dti_band,
               a.monitoring_state as from_state, b.monitoring_state as to_state,
               a.current_actual_upb as from_upb
        from fact a, fact b
        where a.is_on_book_eom and a.loan_id = b.loan_id
          and year(b.as_of_month) * 12 + month(b.as_of_month)
              = year(a.as_of_month) * 12 + month(a.as_of_month) + 1
          and day(a.as_of_month) = 1 and day(b.as_of_month) = 1""",
}

# --- marts --------------------------------------------------------------------

CORE = ["on_book", "delinquency_eligible", "dq30", "dq60", "dq90"]
EXCLUDED = [
    "excluded_pre_due",
    "excluded_loan_age_zero",
    "excluded_invalid_loan_age",
    "excluded_non_numeric_status",
]
_MEMBERS = {
    "on_book": "is_on_book_eom",
    "delinquency_eligible": "is_delinquency_eligible",
    "dq30": "is_delinquency_eligible and delinquency_months > 0",
    "dq60": "is_delinquency_eligible and delinquency_months > 1",
    "dq90": "is_delinquency_eligible and delinquency_months > 2",
    "excluded_pre_due": "is_on_book_eom and monitoring_state = 'PRE_DUE'",
    "excluded_loan_age_zero": "is_on_book_eom and loan_age = 0",
    "excluded_invalid_loan_age": "is_on_book_eom and coalesce(loan_age, -1) < 0",
    "excluded_non_numeric_status": (
        "is_on_book_eom and loan_age > 0 and not is_numeric_delinquency_status"
    ),
}


def both_units(populations: list[str]) -> list[str]:
    return [f"{p}_{unit}" for p in populations for unit in ("loan_count", "upb")]


def _measured(populations: list[str]) -> str:
    return ", ".join(
        f"count(case when {_MEMBERS[p]} then 1 end) as {p}_loan_count, "
        f"cast(coalesce(sum(case when {_MEMBERS[p]} then current_actual_upb end), 0) "
        f"as decimal(38,2)) as {p}_upb"
        for p in populations
    )


def _ratio(top: str, bottom: str) -> str:
    return f"case when {bottom} <> 0 then cast({top} as double) / cast({bottom} as double) end"


_COVERAGE = (
    f"{_ratio('delinquency_eligible_loan_count', 'on_book_loan_count')}"
    " as numeric_status_coverage_count_rate, "
    f"{_ratio('delinquency_eligible_upb', 'on_book_upb')} as numeric_status_coverage_balance_rate"
)
_DQ = ", ".join(
    f"{_ratio(f'dq{d}_loan_count', 'delinquency_eligible_loan_count')} as dq{d}_count_rate, "
    f"{_ratio(f'dq{d}_upb', 'delinquency_eligible_upb')} as dq{d}_balance_rate"
    for d in (30, 60, 90)
)


def _resummed(columns: list[str]) -> str:
    return ", ".join(
        f"cast(sum({c}) as {'decimal(38,2)' if c.endswith('upb') else 'bigint'}) as {c}"
        for c in columns
    )


_FLOW_RATES = (
    f"{_ratio('transition_loan_count', 'observable_from_state_loan_count')}"
    " as transition_count_rate, "
    f"{_ratio('transition_from_upb', 'observable_from_state_upb')} as transition_balance_rate"
)

_MARTS = {
    "monthly_mart": f"""
        select *, {_COVERAGE}, {_DQ} from (
            select as_of_month, {_measured(CORE + EXCLUDED)} from fact group by as_of_month)""",
    "segment_mart": f"""
        select *, {_DQ} from (
            select as_of_month, segment_name, segment_value, {_measured(CORE)}
            from (select *, unnest([
                      {{'segment_name': 'origination_year',
                        'segment_value': cast(origination_year as varchar)}},
                      {{'segment_name': 'classic_fico', 'segment_value': fico_band}},
                      {{'segment_name': 'original_cltv', 'segment_value': cltv_band}},
                      {{'segment_name': 'original_dti', 'segment_value': dti_band}}],
                      recursive := true)
                  from fact)
            group by 1, 2, 3)""",
    "flows": """
        select from_month, to_month,
               if(grouping(origination_year) = 1, 'all', 'origination_year') as segment_name,
               if(grouping(origination_year) = 1, 'All', cast(origination_year as varchar))
                   as segment_value,
               from_state, to_state, count(*) as transition_loan_count,
               cast(sum(from_upb) as decimal(38,2)) as transition_from_upb
        from pairs_joined
        group by grouping sets (
            (from_month, to_month, from_state, to_state),
            (from_month, to_month, origination_year, from_state, to_state))""",
    "flow_cohorts": f"""
        select from_month, segment_name, segment_value, from_state,
               {_resummed(['transition_loan_count', 'transition_from_upb'])}
        from flows group by all""",
    "transition_mart": f"""
        select *, {_FLOW_RATES} from (
            select f.*, c.transition_loan_count as observable_from_state_loan_count,
                   c.transition_from_upb as observable_from_state_upb
            from flows f join flow_cohorts c
              using (from_month, segment_name, segment_value, from_state))""",
    # The tables as the checks see them; the dirty panel tampers with these.
    "monthly": "select * from monthly_mart",
    "segments": "select * from segment_mart",
    "transitions": "select * from transition_mart",
    "pairs": "select * from pairs_joined",
}

# --- suppressed exports (k is filled in per statement) -------------------------

BAND_PLACES = [
    ["<620", "620-659", "660-699", "700-739", "740-779", "780+", "Unknown"],
    ["<=60", "61-70", "71-80", "81-90", "91-95", ">95", "Unknown"],
    ["<=20", "21-30", "31-40", "41-45", "46-50", ">50", "Unknown"],
]


def _list(labels: list[str]) -> str:
    return "[" + ", ".join(f"'{label}'" for label in labels) + "]"


_PLACE = " ".join(
    f"when '{name}' then coalesce(list_position({_list(labels)}, segment_value), 99)"
    for name, labels in zip(["classic_fico", "original_cltv", "original_dti"], BAND_PLACES)
)
_OPEN = ["PRE_DUE", "CURRENT", "30", "60", "90+", "REO_ACQUISITION"]


def _state_place(column: str, other: str = "") -> str:
    return (
        f"case {column} when 'UNKNOWN_LOAN_AGE' then 97 when 'UNKNOWN' then 98 {other} "
        f"else coalesce(list_position({_list(_OPEN)}, {column}) - 1, 6) end"
    )


def _suppressed(k: int) -> dict[str, str]:
    return {
        "segment_low": f"""
            select as_of_month, segment_name,
                   sum(on_book_loan_count) filter (on_book_loan_count < {k}) as low,
                   min(on_book_loan_count) filter (on_book_loan_count >= {k}) as smallest
            from segments group by 1, 2""",
        "segment_joiner": f"""
            select s.as_of_month, s.segment_name, min(s.segment_value) as joiner
            from segments s join segment_low l using (as_of_month, segment_name)
            where l.low > 0 and l.low < {k} and s.on_book_loan_count = l.smallest
            group by 1, 2""",
        "segment_marked": f"""
            select s.*, on_book_loan_count < {k} or coalesce(segment_value = joiner, false) as hit
            from segments s left join segment_joiner using (as_of_month, segment_name)""",
        "segment_export": f"""
            select *, {_COVERAGE}, {_DQ},
                   cast(case segment_name
                        when 'origination_year' then try_cast(segment_value as integer)
                        {_PLACE} else 99 end as integer) as segment_sort_order
            from (select as_of_month, segment_name,
                         if(hit, 'Other / low volume', segment_value) as segment_value,
                         bool_or(hit) as privacy_merged, count(*) as source_mart_row_count,
                         {_resummed(both_units(CORE))}
                  from segment_marked
                  group by 1, 2, 3)""",
        "kept_flows": f"""
            select * from transitions
            where segment_name = 'all' and observable_from_state_loan_count >= {k}""",
        "flow_low": f"""
            select from_month, from_state,
                   sum(transition_loan_count) filter (transition_loan_count < {k}) as low,
                   min(transition_loan_count) filter (transition_loan_count >= {k}) as smallest
            from kept_flows group by 1, 2""",
        "flow_joiner": f"""
            select f.from_month, f.from_state, min(f.to_state) as joiner
            from kept_flows f join flow_low l using (from_month, from_state)
            where l.low > 0 and l.low < {k} and f.transition_loan_count = l.smallest
            group by 1, 2""",
        "flow_marked": f"""
            select f.*, transition_loan_count < {k} or coalesce(to_state = joiner, false) as hit
            from kept_flows f left join flow_joiner using (from_month, from_state)""",
        "transition_export": f"""
            select *, {_FLOW_RATES},
                   cast({_state_place('from_state')} as integer) as from_state_sort_order,
                   cast({_state_place('to_state', "when 'OTHER_OR_LOW_VOLUME' then 99")}
                        as integer) as to_state_sort_order
            from (select from_month, to_month, from_state,
                         if(hit, 'OTHER_OR_LOW_VOLUME', to_state) as to_state,
                         bool_or(hit) as privacy_merged, count(*) as source_mart_row_count,
                         {_resummed(['transition_loan_count', 'transition_from_upb'])},
                         any_value(observable_from_state_loan_count)
                             as observable_from_state_loan_count,
                         any_value(observable_from_state_upb) as observable_from_state_upb
                  from flow_marked group by 1, 2, 3, 4)""",
    }


# --- dirty panel: planted failures ---------------------------------------------

_DIRTY = {
    "orig_text": lambda clean: f"""
        select t.* replace (
                   case when k % 70 = 3 then '900' else classic_fico end as classic_fico,
                   case when k % 75 = 4 then '80' else original_dti end as original_dti,
                   case when k % 80 = 5 then '0' else original_upb end as original_upb)
        from ({clean}) t, range(2) copies(c)
        where k % 50 <> 7 and (c = 0 or k % 90 = 6)""",
    "perf_typed": lambda clean: f"""
        select t.* from (
            select p.* replace (
                case when mp % 501 = 1 then cast(as_of_month - interval '10' year as date)
                     when mp % 503 = 2 then cast(as_of_month + interval '10' year as date)
                     else as_of_month end as as_of_month,
                case when mp % 401 = 3 then 'A1' when mp % 403 = 4 then null
                     else delinquency_status_raw end as delinquency_status_raw,
                case when mp % 401 = 3 or mp % 403 = 4 then null
                     else delinquency_months end as delinquency_months,
                case when mp % 307 = 5 then '77' when mp % 311 = 6 then '01'
                     else zero_balance_code end as zero_balance_code,
                case when mp % 307 = 5 then as_of_month when mp % 311 = 6 then null
                     else zero_balance_effective_month end as zero_balance_effective_month,
                case when mp % 313 = 7 then -100.00 when mp % 317 = 8 then null
                     else current_actual_upb end as current_actual_upb)
            from ({clean}) p) t, range(2) copies(c)
        where k % 60 <> 11 and (c = 0 or mp % 347 = 11)""",
    "perf": lambda clean: f"""
        select p.* replace (
            case when mp % 331 = 9 then not is_on_book_eom else is_on_book_eom end
                as is_on_book_eom,
            case when mp % 337 = 10 then true else is_delinquency_eligible end
                as is_delinquency_eligible)
        from ({clean}) p""",
    "monthly": lambda clean: f"""
        select p.* replace (
            if(as_of_month = date '2020-06-01', dq30_loan_count + 1000000, dq30_loan_count)
                as dq30_loan_count,
            if(as_of_month = date '2021-06-01', dq90_upb + 1000000000000, dq90_upb) as dq90_upb)
        from ({clean}) p""",
    "segments": lambda clean: f"""
        select * from ({clean})
        where not (as_of_month = date '2022-03-01' and segment_name = 'original_dti')""",
    "transitions": lambda clean: f"""
        select p.* replace (
            if(from_month = date '2020-03-01' and to_state = 'CURRENT',
               transition_loan_count + 5, transition_loan_count) as transition_loan_count,
            if(from_month = date '2021-01-01' and to_state = '30',
               transition_count_rate + 0.5, transition_count_rate) as transition_count_rate)
        from ({clean}) p""",
    "pairs": lambda clean: f"""
        select p.* replace (
            if(loan_id[-2:] = '13' and from_month = date '2020-05-01',
               cast(to_month + interval '1' month as date), to_month) as to_month,
            if(loan_id[-2:] = '17', 0, from_upb) as from_upb)
        from ({clean}) p""",
}


def _blocks(k: int, dirty: bool, extra: dict[str, str] | None) -> dict[str, str]:
    blocks = {**_PANEL, **_STAGING, **_CURATED, **_MARTS, **_suppressed(k), **(extra or {})}
    if dirty:
        for name, tamper in _DIRTY.items():
            blocks[name] = tamper(blocks[name])
    return blocks


def statement(
    body: str, k: int = 20, dirty: bool = False, extra: dict[str, str] | None = None
) -> str:
    """The body preceded by the blocks it needs, in dependency order."""
    blocks = _blocks(k, dirty, extra)
    order: list[str] = []

    def need(sql: str) -> None:
        for name in blocks:
            if name not in order and re.search(rf"\b(?:from|join|,)\s+{name}\b", sql):
                need(blocks[name])
                order.append(name)

    need(body)
    if not order:
        return body
    chain = ",\n".join(f"{name} as ({blocks[name]})" for name in order)
    return f"with {chain}\n{body}"


def listed(columns: list[str]) -> str:
    """Column list with amounts as doubles."""
    return ", ".join(
        f"cast({c} as double) as {c}" if c.endswith("_upb") else c for c in columns
    )
