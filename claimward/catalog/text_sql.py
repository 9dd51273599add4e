"""SQL twin of the raw text datasets, the staging tables and the gold tables."""

from claimward.config import CONDITION_FLAGS, CONDITIONS
from claimward.schemas import CHRONIC_COLUMNS, DIAGNOSIS_COLUMNS, PROCEDURE_COLUMNS, RAW_COLUMNS
from claimward.sources.lookups import state_rows
from claimward.sources.star_text import BASE_RULES, BENEFICIARY_RULES, CLAIM_RULES, PROVIDER_RULES
from claimward.catalog.star_sql import mean2, rounded, rows_if, total


def _columns(rules: dict[str, str], names: list[str]) -> str:
    return ",\n    ".join(f"{rules[name]} AS {name}" for name in names)


RAW = f"""
WITH lines AS (SELECT lineitem.*, o_custkey, {_columns(BASE_RULES, list(BASE_RULES))}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw_provider AS (SELECT {_columns(PROVIDER_RULES, RAW_COLUMNS['provider'])} FROM supplier),
raw_inpatient AS (SELECT {_columns(CLAIM_RULES, RAW_COLUMNS['inpatient'])} FROM lines WHERE inpatient),
raw_outpatient AS (SELECT {_columns(CLAIM_RULES, RAW_COLUMNS['outpatient'])} FROM lines WHERE NOT inpatient),
raw_beneficiary AS (SELECT {_columns(BENEFICIARY_RULES, RAW_COLUMNS['beneficiary'])} FROM customer)
"""


def day(x: str) -> str:
    return f"TRY_CAST(trim({x}) AS DATE)"


def num(x: str, kind: str = "INTEGER") -> str:
    return f"TRY_CAST(trim({x}) AS {kind})"


def gap(a: str, b: str) -> str:
    return f"CAST(date_diff('day', {a}, {b}) AS INTEGER)"


def no_na(x: str) -> str:
    return f"CASE WHEN trim({x}) <> 'NA' THEN trim({x}) END"


def slots(names: list[str]) -> str:
    return "CAST(" + " + ".join(
        f"CASE WHEN trim({n}) IN ('NA', '') OR {n} IS NULL THEN 0 ELSE 1 END" for n in names
    ) + " AS INTEGER)"


def _claims(kind: str, table: str) -> str:
    inpatient = kind == "Inpatient"
    adm = day("AdmissionDt") if inpatient else "CAST(NULL AS DATE)"
    dis = day("DischargeDt") if inpatient else "CAST(NULL AS DATE)"
    same = f"coalesce({adm} = {dis}, false)" if inpatient else "CAST(NULL AS BOOLEAN)"
    codes = ", ".join(
        [f"{no_na(n)} AS diagnosis_code_{i}" for i, n in enumerate(DIAGNOSIS_COLUMNS, 1)]
        + [f"{no_na(n)} AS procedure_code_{i}" for i, n in enumerate(PROCEDURE_COLUMNS, 1)]
    )
    return f"""SELECT trim(ClaimID) AS claim_id, trim(BeneID) AS beneficiary_id, trim(Provider) AS provider_id,
    '{kind}' AS claim_type, {day('ClaimStartDt')} AS claim_start_date, {day('ClaimEndDt')} AS claim_end_date,
    {adm} AS admission_date, {dis} AS discharge_date, {num('InscClaimAmtReimbursed')} AS claim_reimbursement_amt,
    CAST(CASE WHEN trim(DeductibleAmtPaid) = 'NA' THEN 0 ELSE {num('DeductibleAmtPaid', 'DECIMAL(10,2)')} END AS DOUBLE)
      AS deductible_amt_paid,
    {no_na('AttendingPhysician')} AS attending_physician_id, {no_na('OperatingPhysician')} AS operating_physician_id,
    {no_na('OtherPhysician')} AS other_physician_id, {codes},
    {gap(day('ClaimStartDt'), day('ClaimEndDt'))} AS claim_duration_days, {gap(adm, dis)} AS admission_duration_days,
    {slots(DIAGNOSIS_COLUMNS)} AS diagnosis_code_count, {slots(PROCEDURE_COLUMNS)} AS procedure_code_count,
    coalesce({num('InscClaimAmtReimbursed')} = 0, false) AS is_zero_reimbursement, {same} AS is_same_day_discharge
  FROM {table}"""


_flags = ", ".join(
    f"CASE WHEN trim({source}) = '1' THEN 1 ELSE 0 END AS {flag}"
    for source, flag in zip(CHRONIC_COLUMNS, CONDITION_FLAGS)
)
_sum = " + ".join(CONDITION_FLAGS)

STAGING = f"""
, clean_beneficiary AS (SELECT * REPLACE (replace(BeneID, '"', '') AS BeneID,
    replace(RenalDiseaseIndicator, '"', '') AS RenalDiseaseIndicator) FROM raw_beneficiary),
stg_provider AS (SELECT trim(Provider) AS provider_id, trim(PotentialFraud) = 'Yes' AS is_potential_fraud
  FROM raw_provider WHERE trim(PotentialFraud) IN ('Yes', 'No')),
stg_b0 AS (SELECT trim(BeneID) AS beneficiary_id, {day('DOB')} AS date_of_birth,
    TRY_CAST({no_na('DOD')} AS DATE) AS date_of_death,
    CASE trim(Gender) WHEN '1' THEN 'Male' WHEN '2' THEN 'Female' END AS gender,
    CASE trim(RenalDiseaseIndicator) WHEN 'Y' THEN 1 WHEN '0' THEN 0 END AS renal_disease_indicator,
    {num('State')} AS state_code, {num('County')} AS county_code, {_flags},
    {num('IPAnnualReimbursementAmt')} AS ip_annual_reimbursement_amt,
    {num('IPAnnualDeductibleAmt')} AS ip_annual_deductible_amt,
    {num('OPAnnualReimbursementAmt')} AS op_annual_reimbursement_amt,
    {num('OPAnnualDeductibleAmt')} AS op_annual_deductible_amt,
    coalesce(trim(DOD) <> 'NA', false) AS is_deceased,
    CAST(2009 - year({day('DOB')}) AS INTEGER) AS patient_age FROM clean_beneficiary),
stg_beneficiary AS (SELECT *, CASE WHEN patient_age < 45 THEN 'Below 45' WHEN patient_age < 55 THEN '45-54'
    WHEN patient_age < 65 THEN '55-64' ELSE '65+' END AS age_group, {_sum} AS chronic_condition_count FROM stg_b0),
stg_ip AS ({_claims('Inpatient', 'raw_inpatient')}),
stg_op AS ({_claims('Outpatient', 'raw_outpatient')}),
stg_claims AS (SELECT * FROM stg_ip UNION ALL SELECT * FROM stg_op)
"""

_states = ", ".join(
    f"({place}, {code}, '{name}', '{abbr}', '{region}')"
    for place, (code, name, abbr, region) in enumerate(state_rows(), 1)
)
_unfold = " UNION ALL ".join(
    f"SELECT '{name}' AS disease_name, beneficiary_key, chronic_condition_count FROM dim_beneficiary WHERE {flag} = 1"
    for flag, name, _ in CONDITIONS
)
AMT = "claim_reimbursement_amt"

GOLD = f"""
, dim_provider AS (SELECT row_number() OVER (ORDER BY provider_id) AS provider_key, provider_id, is_potential_fraud,
    CASE WHEN is_potential_fraud THEN 'Fraud' ELSE 'Not Fraud' END AS fraud_label FROM stg_provider),
dim_beneficiary AS (SELECT row_number() OVER (ORDER BY beneficiary_id) AS beneficiary_key, * FROM stg_beneficiary),
dim_geography AS (SELECT CAST(k AS BIGINT) AS geo_key, CAST(c AS INTEGER) AS state_code, n AS state_name,
    a AS state_abbr, r AS region FROM (VALUES {_states}) AS v(k, c, n, a, r)),
days AS (SELECT CAST(unnest(generate_series(min(claim_start_date), max(claim_start_date), INTERVAL 1 DAY)) AS DATE) AS d
  FROM stg_claims),
dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
    CAST(day(d) AS INTEGER) AS day_of_month, dayname(d) AS day_name,
    CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS INTEGER) AS week_of_year,
    CAST(month(d) AS INTEGER) AS month_num, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_num,
    'Q' || quarter(d) AS quarter_name, CAST(year(d) AS INTEGER) AS year_num, strftime(d, '%Y-%m') AS year_month,
    dayofweek(d) IN (0, 6) AS is_weekend FROM days),
fact_claims AS (SELECT claim_id, provider_key, beneficiary_key,
    CAST(strftime(claim_start_date, '%Y%m%d') AS INTEGER) AS claim_start_date_key, geo_key, claim_type,
    p.is_potential_fraud, {AMT}, deductible_amt_paid, claim_duration_days, admission_duration_days,
    diagnosis_code_count, procedure_code_count, is_zero_reimbursement, is_same_day_discharge
  FROM stg_claims s JOIN dim_provider p USING (provider_id) JOIN dim_beneficiary b USING (beneficiary_id)
  LEFT JOIN dim_geography g ON g.state_code = b.state_code),
agg_provider_summary AS (SELECT provider_id, p.is_potential_fraud, fraud_label, count(*) AS total_claims,
    {rows_if("claim_type = 'Inpatient'")} AS total_ip_claims, {rows_if("claim_type = 'Outpatient'")} AS total_op_claims,
    {total(AMT)} AS total_reimbursement, {mean2(AMT)} AS avg_reimbursement_per_claim,
    max({AMT}) AS max_reimbursement, sum(deductible_amt_paid) AS total_deductible,
    count(DISTINCT beneficiary_key) AS unique_beneficiaries,
    any_value(phys) AS unique_attending_physicians,
    {mean2('claim_duration_days')} AS avg_claim_duration_days,
    {mean2('admission_duration_days')} AS avg_admission_duration_days,
    {mean2('diagnosis_code_count')} AS avg_diagnosis_code_count,
    {mean2('procedure_code_count')} AS avg_procedure_code_count,
    {rows_if('is_zero_reimbursement')} AS zero_reimbursement_claims,
    CAST(sum(CAST(is_same_day_discharge AS INTEGER)) AS BIGINT) AS same_day_discharge_claims,
    {rows_if('is_deceased')} AS deceased_patient_claims
  FROM fact_claims f JOIN dim_provider p USING (provider_key) JOIN dim_beneficiary b USING (beneficiary_key)
  JOIN (SELECT provider_id, count(DISTINCT attending_physician_id) AS phys FROM stg_claims GROUP BY provider_id) USING (provider_id)
  GROUP BY provider_id, p.is_potential_fraud, fraud_label),
agg_state_monthly AS (SELECT coalesce(g.state_code, -1) AS state_code, coalesce(state_name, 'Unmapped') AS state_name,
    coalesce(state_abbr, '--') AS state_abbr, coalesce(region, 'Unmapped') AS region,
    year_num, month_num, month_name, year_month, count(*) AS total_claims,
    {rows_if("claim_type = 'Inpatient'")} AS total_ip_claims, {rows_if("claim_type = 'Outpatient'")} AS total_op_claims,
    {total(AMT)} AS total_reimbursement, {mean2(AMT)} AS avg_reimbursement_per_claim,
    count(DISTINCT provider_key) AS unique_providers, count(DISTINCT beneficiary_key) AS unique_beneficiaries,
    {rows_if('is_potential_fraud')} AS fraud_provider_claims
  FROM fact_claims f JOIN dim_date d ON d.date_key = f.claim_start_date_key LEFT JOIN dim_geography g USING (geo_key)
  GROUP BY ALL),
disease_rows AS ({_unfold}),
disease_people AS (SELECT disease_name, count(*) AS total_beneficiaries, sum(chronic_condition_count) AS cond
  FROM disease_rows GROUP BY ALL),
disease_claims AS (SELECT disease_name, count(*) AS total_claims, {total(AMT)} AS total_reimbursement
  FROM disease_rows JOIN fact_claims USING (beneficiary_key) GROUP BY ALL),
agg_chronic_disease AS (SELECT disease_name, total_beneficiaries,
    {rounded('total_beneficiaries * 100', '(SELECT count(*) FROM dim_beneficiary)')} AS pct_of_all_beneficiaries,
    total_claims, total_reimbursement,
    {rounded('total_reimbursement', 'total_beneficiaries')} AS avg_reimbursement_per_patient,
    {rounded('cond', 'total_beneficiaries')} AS avg_chronic_count_for_patients_with_this
  FROM disease_people JOIN disease_claims USING (disease_name))
"""
