"""Business questions: name -> (DataFrame function, SQL twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimward.catalog.star_sql import STAR, mean, mean2, rounded, rows_if, total, total_if
from claimward.config import CONDITIONS
from claimward.operators import gold
from claimward.plans import executive, financial, geography, operations, population, risk

AMT = "claim_reimbursement_amt"
FRAUD = "is_potential_fraud"
SAME = "coalesce(is_same_day_discharge, false)"
IP, OP = "claim_type = 'Inpatient'", "claim_type = 'Outpatient'"
FRAUD_PROVIDERS = f"count(DISTINCT CASE WHEN {FRAUD} THEN provider_key END)"
DEDUCTIBLE = "CAST(sum(deductible_amt_paid) AS DOUBLE)"

MONTHLY = f"""
, m AS (SELECT year_num, month_num, month_name, year_month, count(*) AS total_claims,
  {total(AMT)} AS total_reimbursement, {rows_if(IP)} AS ip_claims, {rows_if(OP)} AS op_claims,
  {total_if(AMT, FRAUD)} AS fraud_reimbursement, count(DISTINCT provider_key) AS active_providers
  FROM c GROUP BY ALL)
"""

PROVIDERS = f"""
, p AS (SELECT provider_id, fraud_label, is_potential_fraud, count(*) AS total_claims,
  {rows_if(IP)} AS ip_claims, {rows_if(OP)} AS op_claims,
  count(DISTINCT beneficiary_key) AS unique_beneficiaries,
  {total(AMT)} AS total_reimbursement, {mean(AMT)} AS avg_reimbursement,
  max({AMT}) AS max_single_claim, {rows_if('is_deceased')} AS deceased_patient_claims,
  {rows_if(SAME)} AS same_day_discharges, {total_if(AMT, SAME)} AS same_day_reimbursement,
  {mean('diagnosis_code_count')} AS avg_diagnosis_codes,
  max(diagnosis_code_count) AS max_diagnosis_codes,
  {rows_if('diagnosis_code_count = 10')} AS claims_with_max_codes,
  {rows_if('is_zero_reimbursement')} AS zero_reimbursement_claims,
  CAST({rows_if(SAME)} AS DOUBLE) / nullif({rows_if(IP)}, 0) AS same_day_ratio,
  CAST(sum(admission_duration_days) AS DOUBLE) / nullif(count(admission_duration_days), 0) AS avg_los,
  max(admission_duration_days) AS max_los, min(admission_duration_days) AS min_los,
  {rows_if('admission_duration_days > 14')} AS extended_stays,
  {rows_if('admission_duration_days > 30')} AS extreme_stays
  FROM c GROUP BY ALL),
g AS (SELECT {mean(AMT)} AS global_avg_reimbursement,
  {mean('diagnosis_code_count')} AS global_avg_diag,
  {mean('admission_duration_days')} AS global_avg_los,
  stddev_samp(admission_duration_days) AS sd_los,
  CAST({rows_if(SAME)} AS DOUBLE) / nullif({rows_if(IP)}, 0) * 100 AS global_same_day_rate FROM c)
"""


def scored_sql(deceased=(10, 5, 0), same_day=(0.10, 0.05)) -> str:
    return (
        PROVIDERS
        + f"""
, f AS (SELECT p.*, g.global_avg_reimbursement,
  CASE WHEN avg_reimbursement > global_avg_reimbursement * 3 THEN 3
       WHEN avg_reimbursement > global_avg_reimbursement * 2 THEN 2
       WHEN avg_reimbursement > global_avg_reimbursement * 1.5 THEN 1 ELSE 0 END AS reimbursement_signal,
  CASE WHEN deceased_patient_claims > {deceased[0]} THEN 3
       WHEN deceased_patient_claims > {deceased[1]} THEN 2
       WHEN deceased_patient_claims > {deceased[2]} THEN 1 ELSE 0 END AS deceased_signal,
  CASE WHEN same_day_ratio > {same_day[0]} THEN 2 WHEN same_day_ratio > {same_day[1]} THEN 1
       ELSE 0 END AS same_day_signal,
  CASE WHEN avg_diagnosis_codes > 9.5 THEN 2 WHEN avg_diagnosis_codes > 8.5 THEN 1
       ELSE 0 END AS padding_signal,
  CASE WHEN is_potential_fraud THEN 5 ELSE 0 END AS fraud_label_signal FROM p, g),
s AS (SELECT *, reimbursement_signal + deceased_signal + same_day_signal + padding_signal AS evidence_score,
  reimbursement_signal + deceased_signal + same_day_signal + padding_signal + fraud_label_signal AS risk_score
  FROM f),
t AS (SELECT *, CASE WHEN risk_score >= 9 THEN 'Critical' WHEN risk_score >= 6 THEN 'High'
  WHEN risk_score >= 3 THEN 'Medium' WHEN risk_score >= 1 THEN 'Low' ELSE 'Clean' END AS risk_category,
  CASE WHEN risk_score >= 9 THEN 1 WHEN risk_score >= 6 THEN 2 WHEN risk_score >= 3 THEN 3
       WHEN risk_score >= 1 THEN 4 ELSE 5 END AS sort_order FROM s)
"""
    )


ROLLUP = f"""
, r AS (SELECT provider_id, is_potential_fraud, fraud_label, count(*) AS total_claims,
  {rows_if(IP)} AS total_ip_claims, {rows_if(OP)} AS total_op_claims,
  {total(AMT)} AS total_reimbursement, {mean2(AMT)} AS avg_reimbursement_per_claim,
  max({AMT}) AS max_reimbursement, {DEDUCTIBLE} AS total_deductible,
  count(DISTINCT beneficiary_key) AS unique_beneficiaries,
  count(DISTINCT attending_physician_id) AS unique_attending_physicians,
  {mean2('claim_duration_days')} AS avg_claim_duration_days,
  {mean2('admission_duration_days')} AS avg_admission_duration_days,
  {mean2('diagnosis_code_count')} AS avg_diagnosis_code_count,
  {mean2('procedure_code_count')} AS avg_procedure_code_count,
  {rows_if('is_zero_reimbursement')} AS zero_reimbursement_claims,
  CAST(sum(CAST(is_same_day_discharge AS INTEGER)) AS BIGINT) AS same_day_discharge_claims,
  {rows_if('is_deceased')} AS deceased_patient_claims FROM c GROUP BY ALL)
"""

_unfold = " UNION ALL ".join(
    f"SELECT '{name}' AS disease_name, beneficiary_key, chronic_condition_count "
    f"FROM beneficiary WHERE {flag} = 1"
    for flag, name, _ in CONDITIONS
)
DISEASES = f"""
, u AS ({_unfold}),
dp AS (SELECT disease_name, count(*) AS total_beneficiaries,
  sum(chronic_condition_count) AS cond FROM u GROUP BY ALL),
dc AS (SELECT disease_name, count(*) AS total_claims, {total(AMT)} AS total_reimbursement
  FROM u JOIN c USING (beneficiary_key) GROUP BY ALL),
d AS (SELECT disease_name, total_beneficiaries,
  {rounded('total_beneficiaries * 100', '(SELECT count(*) FROM beneficiary)')} AS pct_of_all_beneficiaries,
  total_claims, total_reimbursement,
  {rounded('total_reimbursement', 'total_beneficiaries')} AS avg_reimbursement_per_patient,
  {rounded('cond', 'total_beneficiaries')} AS avg_chronic_count_for_patients_with_this
  FROM dp JOIN dc USING (disease_name))
"""


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form both engines are compared in."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({n: F.col(n).cast("double") for n in names}) if names else df


QUERIES = {
    # --- executive ---------------------------------------------------------------
    "exe_portfolio": (
        executive.portfolio,
        f"""SELECT *, CAST(fraud_providers AS DOUBLE) / nullif(total_providers, 0) * 100 AS fraud_rate_pct,
        CAST(fraud_reimbursement AS DOUBLE) / nullif(total_reimbursement, 0) * 100 AS fraud_reimbursement_pct
        FROM (SELECT count(DISTINCT provider_key) AS total_providers,
        count(DISTINCT beneficiary_key) AS total_beneficiaries, count(*) AS total_claims,
        {total(AMT)} AS total_reimbursement, {mean(AMT)} AS avg_reimbursement_per_claim,
        {DEDUCTIBLE} AS total_deductible, {FRAUD_PROVIDERS} AS fraud_providers,
        {rows_if(FRAUD)} AS fraud_claims, {total_if(AMT, FRAUD)} AS fraud_reimbursement,
        CAST(sum(CAST(is_same_day_discharge AS INTEGER)) AS BIGINT) AS same_day_discharge_count,
        {rows_if('is_deceased')} AS deceased_patient_claims,
        {rows_if('is_zero_reimbursement')} AS zero_reimbursement_claims,
        {mean('claim_duration_days')} AS avg_claim_duration_days,
        {mean('admission_duration_days')} AS avg_admission_days FROM c)""",
    ),
    "exe_monthly_trend": (
        executive.monthly_trend,
        MONTHLY
        + """SELECT *, lag(total_reimbursement) OVER w AS prev_month_reimbursement,
        CAST(total_reimbursement - lag(total_reimbursement) OVER w AS DOUBLE)
          / nullif(lag(total_reimbursement) OVER w, 0) * 100 AS reimbursement_mom_pct,
        CAST(sum(total_reimbursement) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_reimbursement,
        avg(total_reimbursement) OVER (w ROWS 2 PRECEDING) AS rolling_3m_avg_reimbursement
        FROM m WINDOW w AS (ORDER BY year_num, month_num)""",
    ),
    "exe_ip_op_split": (
        executive.claim_type_split,
        f"""SELECT *, CAST(total_claims AS DOUBLE) / sum(total_claims) OVER () * 100 AS claims_pct,
        CAST(total_reimbursement AS DOUBLE) / sum(total_reimbursement) OVER () * 100 AS reimbursement_pct
        FROM (SELECT claim_type, count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
        {mean(AMT)} AS avg_reimbursement, {mean('claim_duration_days')} AS avg_claim_duration,
        {DEDUCTIBLE} AS total_deductible, count(DISTINCT provider_key) AS unique_providers,
        count(DISTINCT beneficiary_key) AS unique_beneficiaries FROM c GROUP BY ALL)""",
    ),
    "exe_fraud_compare": (
        executive.fraud_comparison,
        f"""SELECT *, total_reimbursement // nullif(provider_count, 0) AS avg_reimbursement_per_provider,
        total_claims // nullif(provider_count, 0) AS avg_claims_per_provider
        FROM (SELECT fraud_label, is_potential_fraud, count(DISTINCT provider_key) AS provider_count,
        count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
        {mean(AMT)} AS avg_reimbursement_per_claim, {mean('claim_duration_days')} AS avg_claim_duration,
        {rows_if('is_deceased')} AS deceased_patient_claims,
        CAST(sum(CAST(is_same_day_discharge AS INTEGER)) AS BIGINT) AS same_day_discharges,
        {mean('diagnosis_code_count')} AS avg_diagnosis_codes FROM c GROUP BY ALL)""",
    ),
    "exe_top_states": (
        executive.top_states,
        f"""SELECT *, rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS reimbursement_rank
        FROM (SELECT state_name, state_abbr, region, count(*) AS total_claims,
        count(DISTINCT provider_key) AS unique_providers,
        count(DISTINCT beneficiary_key) AS unique_beneficiaries, {total(AMT)} AS total_reimbursement,
        {mean(AMT)} AS avg_reimbursement_per_claim, {total_if(AMT, FRAUD)} AS fraud_reimbursement,
        {FRAUD_PROVIDERS} AS fraud_providers, {rows_if(FRAUD)} AS fraud_claims
        FROM c WHERE geo_key IS NOT NULL GROUP BY ALL)
        ORDER BY total_reimbursement DESC NULLS LAST, state_name LIMIT 10""",
    ),
    "exe_alerts": (
        executive.alerts,
        f""", k AS (SELECT CAST({FRAUD_PROVIDERS} AS DOUBLE) / nullif(count(DISTINCT provider_key), 0) * 100 AS rate,
        {rows_if('is_deceased')} AS dead, {rows_if(SAME)} AS same FROM c)
        SELECT 'Fraud Rate' AS kpi_name, round(rate, 2) AS kpi_value,
          CASE WHEN rate > 12 THEN 'RED' ELSE 'AMBER' END AS rag_status,
          CASE WHEN rate > 12 THEN 'Fraud rate exceeds 12% critical threshold'
               ELSE 'Fraud rate exceeds 8% monitoring threshold' END AS alert_message
        FROM k WHERE rate > 8
        UNION ALL SELECT 'Deceased Patient Claims', CAST(dead AS DOUBLE), 'RED',
          dead || ' claims found for deceased beneficiaries' FROM k WHERE dead > 0
        UNION ALL SELECT 'Same Day Discharge', CAST(same AS DOUBLE),
          CASE WHEN same > 1000 THEN 'RED' ELSE 'AMBER' END,
          same || ' same-day admissions detected' FROM k WHERE same > 500""",
    ),
    # --- financial ---------------------------------------------------------------
    "fin_waterfall": (
        financial.waterfall,
        PROVIDERS
        + """, b AS (SELECT avg(avg_reimbursement) + 2 * stddev_samp(avg_reimbursement) AS bound FROM p)
        SELECT 'Total Reimbursement' AS category, CAST(sum(total_reimbursement) AS BIGINT) AS amount, 1 AS sort_order FROM p
        UNION ALL SELECT 'Non-Fraud Providers', CAST(coalesce(sum(total_reimbursement) FILTER (WHERE NOT is_potential_fraud), 0) AS BIGINT), 2 FROM p
        UNION ALL SELECT 'Fraud Labeled Providers', CAST(coalesce(sum(total_reimbursement) FILTER (WHERE is_potential_fraud), 0) AS BIGINT), 3 FROM p
        UNION ALL SELECT 'High Risk (Unlabeled)', CAST(coalesce(sum(total_reimbursement) FILTER (WHERE NOT is_potential_fraud AND avg_reimbursement > bound), 0) AS BIGINT), 4 FROM p, b""",
    ),
    "fin_outliers": (
        financial.outliers,
        PROVIDERS
        + """, b AS (SELECT avg(total_reimbursement) AS m, stddev_samp(total_reimbursement) AS s FROM p)
        SELECT provider_id, fraud_label, is_potential_fraud, total_reimbursement, total_claims,
          avg_reimbursement AS avg_reimbursement_per_claim, round(m, 6) AS mean_reimbursement,
          round(s, 6) AS stddev_reimbursement, round(m + s, 6) AS mean_plus_1sd,
          round(m + 2 * s, 6) AS mean_plus_2sd,
          round((total_reimbursement - m) / nullif(s, 0), 6) AS z_score,
          CASE WHEN total_reimbursement > m + 2 * s THEN 'Extreme Outlier (>2 SD)'
               WHEN total_reimbursement > m + s THEN 'Outlier (>1 SD)'
               WHEN total_reimbursement > m THEN 'Above Average' ELSE 'Below Average' END AS outlier_category,
          round(percent_rank() OVER (ORDER BY total_reimbursement NULLS FIRST) * 100, 6) AS percentile_rank
        FROM p, b""",
    ),
    "fin_cost_drivers": (
        financial.cost_drivers,
        f""", x AS (SELECT 'Claim Type' AS dimension, claim_type AS dimension_value, {AMT} AS a FROM c
        UNION ALL SELECT 'Region', region, {AMT} FROM c WHERE geo_key IS NOT NULL
        UNION ALL SELECT 'Fraud Label', fraud_label, {AMT} FROM c
        UNION ALL SELECT 'Age Group', age_group, {AMT} FROM c),
        y AS (SELECT dimension, dimension_value, count(*) AS total_claims, {total('a')} AS total_reimbursement,
        {mean('a')} AS avg_reimbursement FROM x GROUP BY ALL)
        SELECT *, CAST(total_reimbursement AS DOUBLE)
          / sum(total_reimbursement) OVER (PARTITION BY dimension) * 100 AS reimbursement_pct FROM y""",
    ),
    "fin_benchmark": (
        financial.benchmark,
        PROVIDERS
        + """SELECT provider_id, fraud_label, is_potential_fraud, total_claims, unique_beneficiaries,
          total_reimbursement, avg_reimbursement AS avg_reimbursement_per_claim, global_avg_reimbursement,
          avg_reimbursement - global_avg_reimbursement AS vs_benchmark_amt,
          (avg_reimbursement - global_avg_reimbursement) / nullif(global_avg_reimbursement, 0) * 100 AS vs_benchmark_pct,
          deceased_patient_claims, CASE WHEN ip_claims > 0 THEN same_day_discharges END AS same_day_discharges,
          avg_diagnosis_codes,
          rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS reimbursement_rank,
          rank() OVER (ORDER BY avg_reimbursement DESC NULLS LAST) AS avg_reimbursement_rank,
          CASE WHEN avg_reimbursement > global_avg_reimbursement * 2 THEN 'Critical: >200% of Average'
               WHEN avg_reimbursement > global_avg_reimbursement * 1.5 THEN 'High: >150% of Average'
               WHEN avg_reimbursement > global_avg_reimbursement * 1.2 THEN 'Elevated: >120% of Average'
               WHEN avg_reimbursement > global_avg_reimbursement THEN 'Above Average'
               ELSE 'At or Below Average' END AS benchmark_category
        FROM p, g""",
    ),
    "fin_cap_scenarios": (
        financial.cap_scenarios,
        f""", caps AS (SELECT CAST(unnest([10000, 20000, 30000, 40000, 50000]) AS INTEGER) AS cap_amount)
        SELECT cap_amount, {total(AMT)} AS actual_total, {total(f'least({AMT}, cap_amount)')} AS capped_total,
          {total(f'{AMT} - least({AMT}, cap_amount)')} AS potential_savings,
          {rows_if(f'{AMT} > cap_amount')} AS claims_above_cap,
          CAST({rows_if(f'{AMT} > cap_amount')} AS DOUBLE) / count(*) * 100 AS pct_claims_affected
        FROM c, caps GROUP BY cap_amount""",
    ),
    # --- provider risk -----------------------------------------------------------
    "rsk_watchlist": (
        risk.watchlist,
        scored_sql()
        + """SELECT provider_id, fraud_label, is_potential_fraud, risk_score, risk_category, total_claims,
          unique_beneficiaries, ip_claims, op_claims, total_reimbursement, avg_reimbursement,
          global_avg_reimbursement,
          round((avg_reimbursement - global_avg_reimbursement) / nullif(global_avg_reimbursement, 0) * 100, 2) AS vs_benchmark_pct,
          deceased_patient_claims, same_day_discharges, round(same_day_ratio * 100, 2) AS same_day_discharge_pct,
          round(avg_diagnosis_codes, 2) AS avg_diagnosis_codes, max_single_claim, zero_reimbursement_claims,
          rank() OVER (ORDER BY risk_score DESC, total_reimbursement DESC NULLS LAST) AS investigation_priority
        FROM t""",
    ),
    "rsk_factors": (
        risk.factors,
        scored_sql()
        + """SELECT provider_id, fraud_label, is_potential_fraud, reimbursement_signal, deceased_signal,
          same_day_signal, padding_signal, fraud_label_signal, risk_score, evidence_score FROM t""",
    ),
    "rsk_tier": (
        risk.tiers,
        scored_sql() + "SELECT provider_id, risk_score, risk_category FROM t",
    ),
    "rsk_tier_summary": (
        risk.tier_summary,
        scored_sql()
        + """SELECT risk_category, sort_order, count(*) AS provider_count,
          CAST(sum(total_reimbursement) AS BIGINT) AS total_reimbursement,
          CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS pct_of_providers
        FROM t GROUP BY risk_category, sort_order""",
    ),
    "rsk_tier_summary_two_factor": (
        lambda m: risk.tier_summary(m, mode="two_factor"),
        scored_sql().replace(
            "reimbursement_signal + deceased_signal + same_day_signal + padding_signal + fraud_label_signal AS risk_score",
            "reimbursement_signal + fraud_label_signal AS risk_score",
        )
        + """SELECT risk_category, sort_order, count(*) AS provider_count,
          CAST(sum(total_reimbursement) AS BIGINT) AS total_reimbursement,
          CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS pct_of_providers
        FROM t GROUP BY risk_category, sort_order""",
    ),
    "rsk_signal_breakdown": (
        risk.signal_breakdown,
        scored_sql((20, 10, 0), (0.15, 0.05))
        + """SELECT provider_id, fraud_label, reimbursement_signal, deceased_signal, same_day_signal,
          padding_signal, fraud_label_signal, risk_score AS total_risk_score, total_reimbursement
        FROM t ORDER BY risk_score DESC, total_reimbursement DESC NULLS LAST, provider_id LIMIT 30""",
    ),
    "rsk_provider_timeline": (
        risk.timeline,
        f""", x AS (SELECT provider_id, fraud_label, year_num, month_num, month_name, year_month,
        count(*) AS total_claims, {total(AMT)} AS total_reimbursement, {mean(AMT)} AS avg_reimbursement,
        count(DISTINCT beneficiary_key) AS unique_beneficiaries, {rows_if('is_deceased')} AS deceased_claims,
        {rows_if(SAME)} AS same_day_discharges, {mean('diagnosis_code_count')} AS avg_diagnosis_codes
        FROM c GROUP BY ALL)
        SELECT *, lag(total_reimbursement) OVER w AS prev_month_reimbursement,
        CAST(total_reimbursement - lag(total_reimbursement) OVER w AS DOUBLE)
          / nullif(lag(total_reimbursement) OVER w, 0) * 100 AS reimbursement_mom_pct
        FROM x WINDOW w AS (PARTITION BY provider_id ORDER BY year_num, month_num)""",
    ),
    "rsk_top_profile": (
        lambda m: doubles(risk.top_profile(m)),
        ROLLUP
        + f""", g AS (SELECT {mean(AMT)} AS global_avg_reimbursement FROM c)
        SELECT r.* EXCLUDE (total_deductible), global_avg_reimbursement,
          (avg_reimbursement_per_claim - global_avg_reimbursement) / nullif(global_avg_reimbursement, 0) * 100 AS vs_benchmark_pct,
          rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS reimbursement_rank,
          rank() OVER (ORDER BY deceased_patient_claims DESC NULLS LAST) AS deceased_rank,
          rank() OVER (ORDER BY same_day_discharge_claims DESC NULLS LAST) AS same_day_rank
        FROM r, g ORDER BY total_reimbursement DESC NULLS LAST, provider_id LIMIT 20""",
    ),
    # --- population --------------------------------------------------------------
    "pop_kpis": (
        population.kpis,
        """, x AS (SELECT beneficiary_key, any_value(chronic_condition_count) AS n, any_value(patient_age) AS age,
          any_value(is_deceased) AS dead, any_value(gender) AS gender, count(*) AS claims FROM c GROUP BY beneficiary_key)
        SELECT count(*) AS total_beneficiaries, CAST(sum(n) AS DOUBLE) / count(n) AS avg_chronic_conditions,
          CAST(sum(age) AS DOUBLE) / count(age) AS avg_patient_age,
          count(*) FILTER (WHERE dead) AS deceased_beneficiaries,
          CAST(count(*) FILTER (WHERE dead) AS DOUBLE) / count(*) * 100 AS deceased_pct,
          CAST(coalesce(sum(claims) FILTER (WHERE dead), 0) AS BIGINT) AS claims_from_deceased,
          count(*) FILTER (WHERE gender = 'Male') AS male_beneficiaries,
          count(*) FILTER (WHERE gender = 'Female') AS female_beneficiaries FROM x""",
    ),
    "pop_kpis_claim_grain": (
        lambda m: population.kpis(m, grain="claim"),
        f"""SELECT count(DISTINCT beneficiary_key) AS total_beneficiaries,
          {mean('chronic_condition_count')} AS avg_chronic_conditions, {mean('patient_age')} AS avg_patient_age,
          {rows_if('is_deceased')} AS deceased_beneficiaries,
          CAST({rows_if('is_deceased')} AS DOUBLE) / count(DISTINCT beneficiary_key) * 100 AS deceased_pct,
          {rows_if('is_deceased')} AS claims_from_deceased,
          {rows_if("gender = 'Male'")} AS male_beneficiaries,
          {rows_if("gender = 'Female'")} AS female_beneficiaries FROM c""",
    ),
    "pop_high_utilizers": (
        population.high_utilizers,
        f""", x AS (SELECT beneficiary_key, {total(AMT)} AS t FROM c GROUP BY ALL),
        y AS (SELECT t, ntile(10) OVER (ORDER BY t DESC NULLS LAST) AS tile FROM x)
        SELECT count(*) AS high_utilizer_count, {total('t')} AS high_utilizer_reimbursement,
          {mean('t')} AS avg_high_utilizer_reimbursement FROM y WHERE tile = 1""",
    ),
    "pop_age_gender": (
        population.age_gender,
        f"""SELECT *, total_reimbursement // nullif(beneficiary_count, 0) AS avg_cost_per_beneficiary,
          CAST(total_claims AS DOUBLE) / nullif(beneficiary_count, 0) AS avg_claims_per_beneficiary,
          CAST(total_reimbursement AS DOUBLE) / sum(total_reimbursement) OVER () * 100 AS pct_of_total_reimbursement
        FROM (SELECT age_group, gender, count(DISTINCT beneficiary_key) AS beneficiary_count,
          count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
          {mean(AMT)} AS avg_reimbursement_per_claim, {mean('chronic_condition_count')} AS avg_chronic_conditions
          FROM c WHERE gender IS NOT NULL AND age_group IS NOT NULL GROUP BY ALL)""",
    ),
    "pop_disease_burden": (
        lambda m: doubles(population.disease_burden(m)),
        DISEASES
        + """SELECT *, rank() OVER (ORDER BY total_reimbursement DESC) AS cost_rank,
          rank() OVER (ORDER BY total_beneficiaries DESC) AS prevalence_rank,
          rank() OVER (ORDER BY avg_reimbursement_per_patient DESC) AS cost_per_patient_rank,
          round(avg_reimbursement_per_patient / nullif(avg(avg_reimbursement_per_patient) OVER (), 0) * 100, 6) AS cost_intensity_pct,
          round(CAST(total_beneficiaries AS DOUBLE) / nullif(max(total_beneficiaries) OVER (), 0) * 50
            + avg_reimbursement_per_patient / nullif(max(avg_reimbursement_per_patient) OVER (), 0) * 50, 6)
            AS prevention_opportunity_score FROM d""",
    ),
    "pop_utilizer_profile": (
        population.utilizer_profile,
        f""", x AS (SELECT beneficiary_key, count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
          count(DISTINCT provider_key) AS unique_providers, {rows_if(IP)} AS ip_claims, {rows_if(OP)} AS op_claims,
          {mean('claim_duration_days')} AS avg_claim_duration FROM c GROUP BY ALL),
        z AS (SELECT {mean('total_reimbursement')} AS m, stddev_samp(total_reimbursement) AS s FROM x)
        SELECT beneficiary_id, age_group, gender, patient_age, is_deceased, chronic_condition_count, state_code,
          has_alzheimer, has_heart_failure, has_kidney_disease, has_cancer, has_diabetes, has_depression, has_stroke,
          total_claims, total_reimbursement, unique_providers, ip_claims, op_claims, avg_claim_duration,
          m AS avg_beneficiary_reimbursement, round(m + 2 * s, 6) AS mean_plus_2sd,
          CASE WHEN total_reimbursement >= m + 2 * s THEN 'High Utilizer (>= mean + 2 SD)'
               ELSE 'Moderate Utilizer (>= mean + 1 SD)' END AS utilizer_tier,
          (total_reimbursement - m) / nullif(m, 0) * 100 AS vs_avg_pct,
          rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS utilizer_rank
        FROM x JOIN beneficiary USING (beneficiary_key), z WHERE total_reimbursement >= m + s""",
    ),
    "pop_deceased_claims": (
        population.deceased_claims,
        f"""SELECT beneficiary_id, date_of_birth, date_of_death, patient_age, gender, state_code,
          count(*) AS deceased_patient_claims, {total(AMT)} AS total_reimbursement,
          min(claim_start_date) AS first_claim_date, max(claim_start_date) AS last_claim_date,
          count(DISTINCT provider_key) AS unique_providers,
          CAST(date_diff('day', date_of_death, min(claim_start_date)) AS INTEGER) AS days_after_death_first_claim,
          {rows_if('claim_start_date > date_of_death')} AS claims_started_after_death,
          {FRAUD_PROVIDERS} AS fraud_providers_involved
        FROM c WHERE is_deceased
        GROUP BY beneficiary_id, date_of_birth, date_of_death, patient_age, gender, state_code""",
    ),
    "pop_cooccurrence": (
        lambda m: population.cooccurrence(m, min_patients=20),
        f"""SELECT *, total_reimbursement // nullif(beneficiary_count, 0) AS cost_per_beneficiary FROM (
          SELECT concat(CASE WHEN has_diabetes = 1 THEN 'Diabetes ' ELSE '' END,
            CASE WHEN has_heart_failure = 1 THEN 'Heart Failure ' ELSE '' END,
            CASE WHEN has_ischemic_heart = 1 THEN 'Ischemic Heart ' ELSE '' END,
            CASE WHEN has_kidney_disease = 1 THEN 'Kidney Disease ' ELSE '' END,
            CASE WHEN has_depression = 1 THEN 'Depression ' ELSE '' END) AS condition_combination,
            chronic_condition_count, count(DISTINCT beneficiary_key) AS beneficiary_count,
            count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
            {mean(AMT)} AS avg_reimbursement_per_claim
          FROM c WHERE chronic_condition_count >= 3 GROUP BY ALL) WHERE beneficiary_count >= 20""",
    ),
    # --- operations --------------------------------------------------------------
    "ops_kpis": (
        operations.kpis,
        f"""SELECT {mean('admission_duration_days')} AS avg_length_of_stay,
          max(admission_duration_days) AS max_length_of_stay, {rows_if(SAME)} AS total_same_day_discharges,
          CAST({rows_if(SAME)} AS DOUBLE) / nullif({rows_if(IP)}, 0) * 100 AS same_day_discharge_rate_pct,
          {mean('diagnosis_code_count')} AS avg_diagnosis_codes_per_claim,
          max(diagnosis_code_count) AS max_diagnosis_codes,
          {mean('procedure_code_count')} AS avg_procedure_codes_per_claim,
          {rows_if('is_zero_reimbursement')} AS zero_reimbursement_claims,
          CAST({rows_if('is_zero_reimbursement')} AS DOUBLE) / count(*) * 100 AS zero_reimbursement_pct,
          {mean('claim_duration_days')} AS avg_claim_duration_days,
          max(claim_duration_days) AS max_claim_duration_days FROM c""",
    ),
    "ops_los": (
        operations.length_of_stay,
        PROVIDERS
        + """SELECT provider_id, fraud_label, is_potential_fraud, ip_claims, avg_los, max_los, min_los,
          global_avg_los, round(sd_los, 6) AS global_stddev_los, avg_los - global_avg_los AS vs_avg_los,
          extended_stays, extreme_stays,
          CASE WHEN avg_los > global_avg_los + 2 * sd_los THEN 'Extreme Outlier (>2 SD)'
               WHEN avg_los > global_avg_los + sd_los THEN 'Outlier (>1 SD)' ELSE 'Normal' END AS los_anomaly_flag
        FROM p, g WHERE ip_claims >= 10""",
    ),
    "ops_same_day": (
        operations.same_day_providers,
        PROVIDERS
        + """SELECT provider_id, fraud_label, is_potential_fraud, ip_claims AS total_ip_claims,
          same_day_discharges AS same_day_count, same_day_ratio * 100 AS same_day_rate_pct, global_same_day_rate,
          same_day_ratio * 100 - global_same_day_rate AS vs_benchmark_pct, same_day_reimbursement,
          CASE WHEN same_day_ratio > 0.15 THEN 'High Risk (>15%)'
               WHEN same_day_ratio > 0.05 THEN 'Elevated (>5%)' ELSE 'Normal' END AS same_day_risk_flag,
          rank() OVER (ORDER BY same_day_discharges DESC) AS same_day_rank
        FROM p, g WHERE ip_claims >= 5""",
    ),
    "ops_padding": (
        operations.code_padding,
        PROVIDERS
        + """SELECT provider_id, fraud_label, is_potential_fraud, total_claims, avg_diagnosis_codes,
          max_diagnosis_codes, claims_with_max_codes,
          CAST(claims_with_max_codes AS DOUBLE) / nullif(total_claims, 0) * 100 AS max_code_claims_pct,
          global_avg_diag, avg_diagnosis_codes - global_avg_diag AS vs_avg_diag_codes,
          CASE WHEN avg_diagnosis_codes > 9.5 THEN 'High Padding Risk' WHEN avg_diagnosis_codes > 9.0 THEN 'Elevated'
               WHEN avg_diagnosis_codes > 8.5 THEN 'Moderate' ELSE 'Normal' END AS padding_risk_flag,
          total_reimbursement, rank() OVER (ORDER BY avg_diagnosis_codes DESC NULLS LAST) AS padding_rank
        FROM p, g WHERE total_claims >= 20""",
    ),
    "ops_state_mix": (
        operations.state_mix,
        f""", x AS (SELECT state_name, state_abbr, region, count(*) AS total_claims, {rows_if(IP)} AS ip_claims,
          {rows_if(OP)} AS op_claims, {total(AMT)} AS total_reimbursement, {total_if(AMT, IP)} AS ip_reimbursement,
          {total_if(AMT, OP)} AS op_reimbursement,
          CAST(sum({AMT}) FILTER (WHERE {IP}) AS DOUBLE) / nullif(count({AMT}) FILTER (WHERE {IP}), 0) AS ip_avg_reimbursement,
          CAST(sum({AMT}) FILTER (WHERE {OP}) AS DOUBLE) / nullif(count({AMT}) FILTER (WHERE {OP}), 0) AS op_avg_reimbursement
          FROM c WHERE geo_key IS NOT NULL GROUP BY ALL),
        y AS (SELECT *, CAST(ip_claims AS DOUBLE) / nullif(op_claims, 0) AS ip_op_ratio FROM x)
        SELECT *, CAST(ip_reimbursement AS DOUBLE) / nullif(total_reimbursement, 0) * 100 AS ip_reimbursement_pct,
          round(ip_avg_reimbursement - avg(ip_avg_reimbursement) OVER (), 6) AS vs_national_ip_avg,
          CASE WHEN ip_op_ratio > avg(ip_op_ratio) OVER () * 1.5 THEN 'Inpatient Heavy'
               WHEN ip_op_ratio > avg(ip_op_ratio) OVER () * 1.2 THEN 'Slightly Elevated'
               ELSE 'Normal' END AS efficiency_flag,
          rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS state_rank FROM y""",
    ),
    "ops_duration_hist": (
        operations.duration_histogram,
        f""", x AS (SELECT CASE WHEN claim_duration_days = 0 THEN '0 days (Same Day)'
            WHEN claim_duration_days <= 3 THEN '1-3 days' WHEN claim_duration_days <= 7 THEN '4-7 days'
            WHEN claim_duration_days <= 14 THEN '8-14 days' WHEN claim_duration_days <= 30 THEN '15-30 days'
            ELSE '30+ days' END AS duration_bucket, * FROM c)
        SELECT duration_bucket, claim_type, count(*) AS claim_count, {total(AMT)} AS total_reimbursement,
          {mean(AMT)} AS avg_reimbursement, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS pct_of_total,
          CASE duration_bucket WHEN '0 days (Same Day)' THEN 1 WHEN '1-3 days' THEN 2 WHEN '4-7 days' THEN 3
            WHEN '8-14 days' THEN 4 WHEN '15-30 days' THEN 5 ELSE 6 END AS sort_order
        FROM x GROUP BY duration_bucket, claim_type""",
    ),
    # --- geography and trends ----------------------------------------------------
    "geo_state": (
        geography.states,
        f""", x AS (SELECT state_name, state_abbr, state_code, region, count(*) AS total_claims,
          count(DISTINCT provider_key) AS unique_providers, count(DISTINCT beneficiary_key) AS unique_beneficiaries,
          {rows_if(IP)} AS ip_claims, {rows_if(OP)} AS op_claims, {total(AMT)} AS total_reimbursement,
          {mean(AMT)} AS avg_reimbursement_per_claim, {DEDUCTIBLE} AS total_deductible,
          {FRAUD_PROVIDERS} AS fraud_providers, {total_if(AMT, FRAUD)} AS fraud_reimbursement,
          {rows_if('is_deceased')} AS deceased_patient_claims, {rows_if(SAME)} AS same_day_discharges
          FROM c WHERE geo_key IS NOT NULL GROUP BY ALL),
        n AS (SELECT {mean(AMT)} AS national_avg_reimbursement FROM c WHERE geo_key IS NOT NULL),
        y AS (SELECT *, CAST(fraud_providers AS DOUBLE) / nullif(unique_providers, 0) * 100 AS fraud_rate_pct FROM x, n)
        SELECT *, avg_reimbursement_per_claim - national_avg_reimbursement AS vs_national_avg_amt,
          (avg_reimbursement_per_claim - national_avg_reimbursement) / nullif(national_avg_reimbursement, 0) * 100 AS vs_national_avg_pct,
          CASE WHEN avg_reimbursement_per_claim > national_avg_reimbursement * 1.3 THEN 'High Cost State'
               WHEN avg_reimbursement_per_claim > national_avg_reimbursement * 1.1 THEN 'Above Average'
               WHEN avg_reimbursement_per_claim < national_avg_reimbursement * 0.9 THEN 'Efficient State'
               ELSE 'Average' END AS performance_flag,
          rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS reimbursement_rank,
          rank() OVER (ORDER BY total_claims DESC) AS claim_volume_rank,
          rank() OVER (ORDER BY fraud_rate_pct DESC NULLS LAST) AS fraud_rate_rank FROM y""",
    ),
    "geo_region": (
        geography.regions,
        f""", n AS (SELECT sum({AMT}) AS na, count(*) AS nc, {mean(AMT)} AS national_avg_reimbursement FROM c),
        x AS (SELECT region, count(DISTINCT state_code) AS state_count, count(*) AS total_claims,
          count(DISTINCT provider_key) AS unique_providers, count(DISTINCT beneficiary_key) AS unique_beneficiaries,
          {total(AMT)} AS total_reimbursement, {mean(AMT)} AS avg_reimbursement_per_claim,
          {FRAUD_PROVIDERS} AS fraud_providers FROM c WHERE geo_key IS NOT NULL AND region <> 'Unknown' GROUP BY ALL)
        SELECT x.*, CAST(fraud_providers AS DOUBLE) / nullif(unique_providers, 0) * 100 AS fraud_rate_pct,
          national_avg_reimbursement, avg_reimbursement_per_claim - national_avg_reimbursement AS vs_national_amt,
          (avg_reimbursement_per_claim - national_avg_reimbursement) / nullif(national_avg_reimbursement, 0) * 100 AS vs_national_pct,
          CAST(total_reimbursement AS DOUBLE) / na * 100 AS pct_of_national_reimbursement,
          CAST(total_claims AS DOUBLE) / nc * 100 AS pct_of_national_claims FROM x, n""",
    ),
    "geo_trend_anomaly": (
        geography.trend_anomalies,
        MONTHLY
        + """, s AS (SELECT *, avg(total_reimbursement) OVER () AS a, stddev_samp(total_reimbursement) OVER () AS sd,
          lag(total_reimbursement) OVER w AS prev_month_reimb, lag(total_claims) OVER w AS prev_month_claims,
          avg(total_reimbursement) OVER (w ROWS 2 PRECEDING) AS rolling_3m_avg,
          CAST(sum(total_reimbursement) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_reimbursement
          FROM m WINDOW w AS (ORDER BY year_num, month_num))
        SELECT * EXCLUDE (a, sd), round(a, 6) AS overall_avg, round(sd, 6) AS overall_stddev,
          CAST(total_reimbursement - prev_month_reimb AS DOUBLE) / nullif(prev_month_reimb, 0) * 100 AS reimbursement_mom_pct,
          CAST(total_claims - prev_month_claims AS DOUBLE) / nullif(prev_month_claims, 0) * 100 AS claims_mom_pct,
          CASE WHEN total_reimbursement > a + 1.5 * sd THEN 'Anomaly: Unusually High'
               WHEN total_reimbursement < a - 1.5 * sd THEN 'Anomaly: Unusually Low' ELSE 'Normal' END AS anomaly_flag,
          CAST(fraud_reimbursement AS DOUBLE) / nullif(total_reimbursement, 0) * 100 AS fraud_reimb_pct FROM s""",
    ),
    "geo_quadrant": (
        geography.quadrants,
        f""", x AS (SELECT state_name, state_abbr, region, count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
          {mean(AMT)} AS avg_reimbursement, {FRAUD_PROVIDERS} AS fraud_provider_count,
          count(DISTINCT provider_key) AS total_providers FROM c WHERE geo_key IS NOT NULL GROUP BY ALL),
        n AS (SELECT quantile_cont(CAST(total_claims AS DOUBLE), 0.5) AS median_claims,
          quantile_cont(CAST(total_reimbursement AS DOUBLE), 0.5) AS median_reimbursement FROM x)
        SELECT *, CASE WHEN total_claims > median_claims AND total_reimbursement > median_reimbursement THEN 'High Volume High Cost'
          WHEN total_claims > median_claims THEN 'High Volume Low Cost'
          WHEN total_reimbursement > median_reimbursement THEN 'Low Volume High Cost'
          ELSE 'Low Volume Low Cost' END AS quadrant FROM x, n""",
    ),
    "geo_season": (
        geography.seasons,
        f""", x AS (SELECT month_name, month_num, year_num, count(*) AS total_claims,
          {total(AMT)} AS total_reimbursement, {mean(AMT)} AS avg_reimbursement FROM c GROUP BY ALL)
        SELECT *, CAST(total_reimbursement AS DOUBLE)
            / nullif(sum(total_reimbursement) OVER (PARTITION BY year_num), 0) * 100 AS pct_of_year_total,
          round(avg_reimbursement - avg(avg_reimbursement) OVER (PARTITION BY month_num), 6) AS vs_month_avg FROM x""",
    ),
    "geo_fraud_density": (
        geography.fraud_density,
        f""", x AS (SELECT state_name, state_abbr, region, count(DISTINCT provider_key) AS total_providers,
          {FRAUD_PROVIDERS} AS fraud_providers,
          count(DISTINCT CASE WHEN NOT {FRAUD} THEN provider_key END) AS clean_providers,
          {total_if(AMT, FRAUD)} AS fraud_reimbursement, {total(AMT)} AS total_reimbursement
          FROM c WHERE geo_key IS NOT NULL GROUP BY ALL),
        y AS (SELECT *, CAST(fraud_providers AS DOUBLE) / nullif(total_providers, 0) * 100 AS fraud_rate_pct,
          CAST(fraud_reimbursement AS DOUBLE) / nullif(total_reimbursement, 0) * 100 AS fraud_exposure_pct FROM x)
        SELECT *, rank() OVER (ORDER BY fraud_rate_pct DESC NULLS LAST) AS fraud_rate_rank,
          rank() OVER (ORDER BY fraud_reimbursement DESC) AS fraud_exposure_rank FROM y""",
    ),
    # --- gold rollups over the typed model ---------------------------------------
    "gld_agg_provider": (
        lambda m: doubles(gold.provider_rollup(m)),
        ROLLUP + "SELECT * FROM r",
    ),
    "gld_agg_state_month": (
        lambda m: doubles(gold.state_month_rollup(m)),
        f"""SELECT state_code, state_name, state_abbr, region, year_num, month_num, month_name, year_month,
          count(*) AS total_claims, {rows_if(IP)} AS total_ip_claims, {rows_if(OP)} AS total_op_claims,
          {total(AMT)} AS total_reimbursement, {mean2(AMT)} AS avg_reimbursement_per_claim,
          count(DISTINCT provider_key) AS unique_providers, count(DISTINCT beneficiary_key) AS unique_beneficiaries,
          {rows_if(FRAUD)} AS fraud_provider_claims FROM c
        GROUP BY state_code, state_name, state_abbr, region, year_num, month_num, month_name, year_month""",
    ),
    "gld_agg_disease": (
        lambda m: doubles(gold.disease_rollup(m)),
        DISEASES + "SELECT * FROM d",
    ),
}

ORACLES = {name: STAR + sql for name, (_, sql) in QUERIES.items()}
