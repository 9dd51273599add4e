"""Metrics, what-ifs, decision lists and report data sets with their SQL twins."""

from __future__ import annotations

from claimward.catalog.business import (
    AMT,
    FRAUD,
    FRAUD_PROVIDERS,
    IP,
    OP,
    PROVIDERS,
    ROLLUP,
    SAME,
    scored_sql,
)
from claimward.catalog.star_sql import STAR, mean, rows_if, total, total_if
from claimward.config import CONDITIONS
from claimward.operators import decisions, distinct, metrics
from claimward.plans import reports
from claimward.plans.risk import FACTORS
from claimward.sources import lookups
from pyspark.sql import functions as F

# Report ratios are 0 instead of NULL, otherwise the score is the one of the risk queries.
SCORES = (
    scored_sql()
    + """, q AS (SELECT *, coalesce(same_day_ratio, 0) AS rate, avg_diagnosis_codes AS codes,
  CASE WHEN total_claims < 5 THEN 'Insufficient Volume'
       WHEN coalesce(same_day_ratio, 0) > 0.10 AND avg_diagnosis_codes > 8.5 THEN 'Payment Hold'
       WHEN coalesce(same_day_ratio, 0) > 0.10 OR avg_diagnosis_codes > 8.5 THEN 'Pre-Payment Review'
       ELSE 'Standard Processing' END AS payment_decision FROM t)
"""
)
SIGNALS = ", ".join(FACTORS)


def zero(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0)"


def one(name: str, *more: str):
    """A metric by region: the smallest useful grouping."""
    names = [name, *more]
    return lambda m: metrics.metrics(m, names, ["region"])


def by_region(columns: str) -> str:
    return f"SELECT region, {columns} FROM c GROUP BY region"


MONTH_ROWS = f"""
, m AS (SELECT year_num, month_num, count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
  make_date(year_num, month_num, 1) AS first_day FROM c GROUP BY ALL)
"""
CARE = f"""
, scope AS (SELECT DISTINCT beneficiary_key FROM c),
b2 AS (SELECT *, ip_annual_reimbursement_amt + op_annual_reimbursement_amt AS annual_cost,
  beneficiary_key IN (SELECT beneficiary_key FROM scope) AS has_claims FROM beneficiary),
pool AS (SELECT * FROM b2 WHERE has_claims AND chronic_condition_count >= 6 AND annual_cost >= 10000)
"""
RANGE_COLUMNS = f"""count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
  count(DISTINCT provider_key) AS unique_providers, {FRAUD_PROVIDERS} AS fraud_providers,
  count(DISTINCT beneficiary_key) AS unique_beneficiaries,
  {zero(FRAUD_PROVIDERS, 'count(DISTINCT provider_key)')} AS fraud_rate,
  {zero(f'sum({AMT})', 'count(DISTINCT beneficiary_key)')} AS avg_reimbursement_per_beneficiary"""
CAPACITIES = """, placed AS (SELECT annual_cost, row_number() OVER (ORDER BY annual_cost DESC) AS place FROM pool),
n AS (SELECT CAST(unnest(range({first}, {last} + 1, {step})) AS BIGINT) AS care_manager_capacity),
size AS (SELECT count(*) AS pool_size FROM pool)
SELECT care_manager_capacity, any_value(pool_size) AS pool_size,
  least(care_manager_capacity, any_value(pool_size)) AS recommended_enrollment,
  CAST(coalesce(sum(annual_cost), 0) AS BIGINT) AS enrolled_cost,
  CAST(coalesce(sum(annual_cost), 0) AS BIGINT) * CAST(0.12 AS DOUBLE) AS projected_savings,
  min(annual_cost) AS lowest_enrolled_cost
FROM n CROSS JOIN size LEFT JOIN placed ON place <= care_manager_capacity GROUP BY care_manager_capacity
"""
_list_counts = " UNION ALL ".join(
    f"SELECT '{name.replace(chr(39), chr(39) * 2)}' AS disease_name, "
    f"count(*) FILTER (WHERE {flag} = 1 AND has_claims) AS beneficiary_count FROM b2"
    for flag, _, name in CONDITIONS
)


def top_sql(cte: str, name: str, item: str, value: str, n: int) -> str:
    return (
        f"(SELECT '{name}' AS set_name, CAST({item} AS VARCHAR) AS item, CAST({value} AS DOUBLE) AS value "
        f"FROM {cte} ORDER BY {value} DESC NULLS LAST, CAST({item} AS VARCHAR) LIMIT {n})"
    )


CAP_COLUMNS = f"""cap_amount, {total(AMT)} AS actual_total, {total(f'least({AMT}, cap_amount)')} AS capped_total,
  {total(f'{AMT} - least({AMT}, cap_amount)')} AS potential_savings,
  {rows_if(f'{AMT} > cap_amount')} AS claims_above_cap,
  CAST({rows_if(f'{AMT} > cap_amount')} AS DOUBLE) / count(*) * 100 AS pct_claims_affected"""

SLICE = {"region": ["ASIA", "EUROPE"], "claim_type": ["Outpatient"], "gender": ["Female"], "age_group": ["65+", "55-64"], "fraud_label": ["Not Fraud"]}

QUERIES = {
    # --- metrics -----------------------------------------------------------------
    "met_claims": (one("total_claims"), by_region("count(*) AS total_claims")),
    "met_amount": (one("total_reimbursement"), by_region(f"{total(AMT)} AS total_reimbursement")),
    "met_deductible": (
        one("total_deductible"),
        by_region("CAST(sum(deductible_amt_paid) AS DOUBLE) AS total_deductible"),
    ),
    "met_providers": (
        one("total_providers"),
        by_region("count(DISTINCT provider_key) AS total_providers"),
    ),
    "met_beneficiaries": (
        one("total_beneficiaries"),
        by_region("count(DISTINCT beneficiary_key) AS total_beneficiaries"),
    ),
    "met_avg_per_claim": (
        one("avg_reimbursement_per_claim"),
        by_region(f"{zero(f'sum({AMT})', 'count(*)')} AS avg_reimbursement_per_claim"),
    ),
    "met_avg_per_beneficiary": (
        one("avg_reimbursement_per_beneficiary"),
        by_region(
            f"{zero(f'sum({AMT})', 'count(DISTINCT beneficiary_key)')} AS avg_reimbursement_per_beneficiary"
        ),
    ),
    "met_avg_duration": (
        one("avg_claim_duration_days"),
        by_region(f"{mean('claim_duration_days')} AS avg_claim_duration_days"),
    ),
    "met_avg_codes": (
        one("avg_diagnosis_codes", "diagnosis_padding_score"),
        by_region(
            f"{mean('diagnosis_code_count')} AS avg_diagnosis_codes, "
            f"{mean('diagnosis_code_count')} AS diagnosis_padding_score"
        ),
    ),
    "met_avg_los": (
        one("avg_length_of_stay"),
        by_region(f"{mean('admission_duration_days')} AS avg_length_of_stay"),
    ),
    "met_fraud_providers": (
        one("fraud_providers", "high_risk_provider_count"),
        by_region(f"{FRAUD_PROVIDERS} AS fraud_providers, {FRAUD_PROVIDERS} AS high_risk_provider_count"),
    ),
    "met_fraud_rate": (
        one("fraud_rate"),
        by_region(f"{zero(FRAUD_PROVIDERS, 'count(DISTINCT provider_key)')} AS fraud_rate"),
    ),
    "met_fraud_amount": (
        one("fraud_reimbursement"),
        by_region(f"{total_if(AMT, FRAUD)} AS fraud_reimbursement"),
    ),
    "met_fraud_amount_share": (
        one("fraud_reimbursement_share"),
        by_region(f"{zero(total_if(AMT, FRAUD), f'sum({AMT})')} AS fraud_reimbursement_share"),
    ),
    "met_nonfraud_amount": (
        one("non_fraud_reimbursement"),
        by_region(f"{total_if(AMT, f'NOT {FRAUD}')} AS non_fraud_reimbursement"),
    ),
    "met_deceased_claims": (
        one("deceased_patient_claims"),
        by_region(f"{rows_if('is_deceased')} AS deceased_patient_claims"),
    ),
    "met_zero_claims": (
        one("zero_reimbursement_claims"),
        by_region(f"{rows_if('is_zero_reimbursement')} AS zero_reimbursement_claims"),
    ),
    "met_same_day": (
        one("same_day_discharge_count"),
        by_region(f"{rows_if(SAME)} AS same_day_discharge_count"),
    ),
    "met_same_day_rate": (
        one("same_day_discharge_rate"),
        by_region(f"{zero(rows_if(SAME), rows_if(IP))} AS same_day_discharge_rate"),
    ),
    "met_ip": (
        one("ip_claims", "ip_reimbursement", "ip_avg_reimbursement"),
        by_region(
            f"{rows_if(IP)} AS ip_claims, {total_if(AMT, IP)} AS ip_reimbursement, "
            f"{zero(total_if(AMT, IP), rows_if(IP))} AS ip_avg_reimbursement"
        ),
    ),
    "met_op": (
        one("op_claims", "op_reimbursement", "op_avg_reimbursement"),
        by_region(
            f"{rows_if(OP)} AS op_claims, {total_if(AMT, OP)} AS op_reimbursement, "
            f"{zero(total_if(AMT, OP), rows_if(OP))} AS op_avg_reimbursement"
        ),
    ),
    "met_global_avg": (
        lambda m: metrics.global_average(m, {"region": ["ASIA"], "fraud_label": ["Fraud"]}),
        f"SELECT {mean(AMT)} AS global_avg_reimbursement FROM c WHERE region = 'ASIA'",
    ),
    "met_vs_benchmark": (
        metrics.benchmark_gap,
        PROVIDERS
        + """SELECT provider_id, fraud_label, is_potential_fraud, avg_reimbursement AS avg_reimbursement_per_claim,
        global_avg_reimbursement,
        (avg_reimbursement - global_avg_reimbursement) / global_avg_reimbursement AS vs_benchmark FROM p, g""",
    ),
    "met_risk_score": (
        metrics.risk_scores,
        SCORES + f"SELECT provider_id, fraud_label, is_potential_fraud, {SIGNALS}, risk_score FROM q",
    ),
    "met_risk_tier": (
        metrics.risk_tiers,
        SCORES + "SELECT provider_id, risk_score, risk_category FROM q",
    ),
    "met_tier_counts": (
        metrics.tier_counts,
        SCORES
        + "SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE risk_category = '{t}') AS {name}"
            for name, t in metrics.TIER_COUNTS.items()
        )
        + " FROM q",
    ),
    "met_outlier_providers": (
        metrics.outlier_providers,
        ROLLUP
        + f""", g AS (SELECT {mean(AMT)} AS base FROM c)
        SELECT count(*) AS outlier_providers FROM r, g WHERE avg_reimbursement_per_claim > base * 1.5""",
    ),
    "met_mom": (
        metrics.month_over_month,
        MONTH_ROWS
        + """SELECT a.year_num, a.month_num, a.total_reimbursement, b.total_reimbursement AS prev_calendar_month,
        coalesce(CAST(a.total_reimbursement - b.total_reimbursement AS DOUBLE) / nullif(b.total_reimbursement, 0), 0) AS reimbursement_mom
        FROM m a LEFT JOIN m b ON b.first_day = a.first_day - INTERVAL 1 MONTH""",
    ),
    "met_ytd": (
        metrics.year_to_date,
        MONTH_ROWS
        + """SELECT year_num, month_num, total_reimbursement,
        (SELECT CAST(sum(b.total_reimbursement) AS BIGINT) FROM m b
         WHERE b.year_num = a.year_num AND b.month_num <= a.month_num) AS reimbursement_ytd FROM m a""",
    ),
    "met_rolling_claims_3m": (
        metrics.rolling_claims,
        MONTH_ROWS
        + """SELECT year_num, month_num, total_claims, (SELECT CAST(sum(b.total_claims) AS BIGINT) FROM m b
         WHERE b.first_day BETWEEN a.first_day - INTERVAL 2 MONTH AND a.first_day) AS claims_rolling_3m FROM m a""",
    ),
    "met_rolling_amount_3m": (
        metrics.rolling_amount,
        MONTH_ROWS
        + """SELECT year_num, month_num, total_reimbursement, (SELECT CAST(sum(b.total_reimbursement) AS BIGINT) FROM m b
         WHERE b.first_day BETWEEN a.first_day - INTERVAL 2 MONTH AND a.first_day) AS reimbursement_rolling_3m FROM m a""",
    ),
    "met_rolling_by_day": (
        metrics.rolling_by_day,
        f""", d AS (SELECT claim_start_date, count(*) AS n, {total(AMT)} AS a FROM c GROUP BY ALL)
        SELECT x.claim_start_date, CAST(sum(y.n) AS BIGINT) AS claims_rolling_3m,
          CAST(sum(y.a) AS BIGINT) AS reimbursement_rolling_3m
        FROM d x JOIN d y ON y.claim_start_date <= x.claim_start_date
          AND y.claim_start_date > x.claim_start_date - INTERVAL 3 MONTH GROUP BY x.claim_start_date""",
    ),
    "met_alerts": (
        metrics.alert_texts,
        f""", k AS (SELECT {zero(FRAUD_PROVIDERS, 'count(DISTINCT provider_key)')} AS rate,
          {rows_if('is_deceased')} AS dead FROM c)
        SELECT CASE WHEN rate > 0.12 THEN 'HIGH ALERT' WHEN rate > 0.08 THEN 'MONITOR' ELSE 'NORMAL' END AS fraud_rate_rag,
          CASE WHEN dead > 0 THEN format('{{:,}}', dead) || ' Claims from Deceased Patients'
               ELSE 'No Deceased Patient Claims' END AS deceased_claims_alert FROM k""",
    ),
    "met_exposure_text": (
        metrics.exposure_text,
        f"""SELECT 'Fraud Exposure: $' || format('{{:,}}', {total_if(AMT, FRAUD)}) || ' ('
          || format('{{:.1f}}', {zero(total_if(AMT, FRAUD), f'sum({AMT})')} * 100) || '% of total)'
          AS fraud_exposure_summary FROM c""",
    ),
    "met_briefing": (
        decisions.briefing,
        SCORES
        + CARE
        + """, k AS (SELECT sum(total_reimbursement) AS a, count(*) FILTER (WHERE is_potential_fraud) AS fp,
          count(*) AS np, sum(total_reimbursement) FILTER (WHERE is_potential_fraud) AS fa,
          count(*) FILTER (WHERE risk_score >= 6) AS n6, coalesce(sum(total_reimbursement) FILTER (WHERE risk_score >= 6), 0) AS a6,
          coalesce(sum(total_reimbursement) FILTER (WHERE payment_decision IN ('Payment Hold', 'Pre-Payment Review')), 0) AS ar FROM q)
        SELECT concat('Reimbursement: $', format('{:,.1f}', a / 1000000), 'M | Fraud: ',
          format('{:.1f}', CAST(fp AS DOUBLE) / np * 100), '% ($', format('{:,.1f}', fa / 1000000), 'M, ',
          format('{:.1f}', CAST(fa AS DOUBLE) / a * 100), '% of total) | At Threshold: ', format('{:,}', n6),
          ' providers ($', format('{:,.1f}', a6 / 1000000), 'M) | Care Mgmt: ',
          format('{:,}', least(5000, (SELECT count(*) FROM pool))), ' enrolled | Billing Review: $',
          format('{:,.1f}', ar / 1000000), 'M') AS briefing FROM k""",
    ),
    "met_by_name": (
        lambda m: metrics.by_name(m, "Provider Risk Score", ["provider_id"]),
        SCORES + "SELECT provider_id, risk_score AS selected_metric FROM q",
    ),
    "val_risk_recon": (
        metrics.reconciliation,
        SCORES + "SELECT count(*) AS providers, CAST(0 AS BIGINT) AS mismatches FROM q",
    ),
    # --- distinct counts that add up ---------------------------------------------
    "met_distinct_range": (
        lambda m: distinct.range_metrics(m, ["region"], months=(199502, 199704)),
        f"SELECT region, {RANGE_COLUMNS} FROM c WHERE year_num * 100 + month_num BETWEEN 199502 AND 199704 "
        "GROUP BY region",
    ),
    "met_distinct_total": (
        lambda m: distinct.range_metrics(m, filters={"region": ["ASIA", "EUROPE"]}),
        f"SELECT {RANGE_COLUMNS} FROM c WHERE region IN ('ASIA', 'EUROPE')",
    ),
    "met_distinct_rolling": (
        lambda m: distinct.rolling_distinct(m, 3, ["region"]),
        """, ends AS (SELECT DISTINCT year_num, month_num, month_name, year_month FROM c)
        SELECT region, e.*, count(DISTINCT provider_key) AS unique_providers,
          count(DISTINCT provider_key) FILTER (WHERE is_potential_fraud) AS fraud_providers,
          count(DISTINCT beneficiary_key) AS unique_beneficiaries
        FROM ends e JOIN c ON e.year_num * 12 + e.month_num - (c.year_num * 12 + c.month_num) BETWEEN 0 AND 2
        GROUP BY ALL""",
    ),
    # --- what-if -----------------------------------------------------------------
    "wif_cap": (
        decisions.cap_effect,
        f", caps AS (SELECT 20000 AS cap_amount) SELECT {CAP_COLUMNS} FROM c, caps GROUP BY cap_amount",
    ),
    "wif_cap_grid": (
        decisions.cap_series,
        ", caps AS (SELECT CAST(unnest(range(5000, 50001, 5000)) AS INTEGER) AS cap_amount) "
        f"SELECT {CAP_COLUMNS} FROM c, caps GROUP BY cap_amount",
    ),
    "wif_threshold": (
        decisions.threshold_effect,
        SCORES
        + """SELECT count(*) AS providers_above_threshold,
        CAST(coalesce(sum(total_reimbursement), 0) AS BIGINT) AS at_risk_reimbursement FROM q WHERE risk_score >= 6""",
    ),
    "wif_threshold_grid": (
        decisions.threshold_series,
        SCORES
        + """, th AS (SELECT CAST(unnest(range(1, 16)) AS INTEGER) AS threshold)
        SELECT threshold, count(provider_id) AS providers_above_threshold,
        CAST(coalesce(sum(total_reimbursement), 0) AS BIGINT) AS at_risk_reimbursement
        FROM th LEFT JOIN q ON risk_score >= threshold GROUP BY threshold""",
    ),
    "wif_care_capacity": (
        decisions.care_capacity,
        CARE
        + "SELECT count(*) AS pool_size, least(5000, count(*)) AS recommended_enrollment FROM pool",
    ),
    "wif_care_capacity_series": (
        decisions.care_capacity_series,
        CARE + CAPACITIES.format(first=500, last=20000, step=500),
    ),
    "wif_care_capacity_fine_series": (
        lambda m: decisions.care_capacity_series(m, series=(1, 400, 3)),
        CARE + CAPACITIES.format(first=1, last=400, step=3),
    ),
    # --- decision lists ----------------------------------------------------------
    "dec_top_n_providers": (
        lambda m: decisions.top_n_providers(m, 10),
        PROVIDERS
        + """SELECT * FROM (SELECT provider_id, fraud_label, is_potential_fraud, total_reimbursement,
        dense_rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS provider_rank, 1 AS top_n_flag FROM p)
        WHERE provider_rank <= 10""",
    ),
    "dec_payment_hold": (
        decisions.payment_holds,
        SCORES
        + """SELECT provider_id, fraud_label, is_potential_fraud, total_claims, total_reimbursement,
        rate AS same_day_discharge_rate, codes AS diagnosis_padding_score, payment_decision FROM q""",
    ),
    "dec_under_review_amount": (
        decisions.under_review_amount,
        SCORES
        + """SELECT count(*) AS providers_under_review,
        CAST(coalesce(sum(total_reimbursement), 0) AS BIGINT) AS under_review_amount FROM q
        WHERE payment_decision IN ('Payment Hold', 'Pre-Payment Review')""",
    ),
    "dec_care_priority": (
        decisions.care_priority,
        CARE
        + """SELECT beneficiary_id, chronic_condition_count, annual_cost,
        CASE WHEN NOT has_claims THEN 'No Claims in Scope'
             WHEN chronic_condition_count >= 6 AND annual_cost >= 10000 THEN 'High Priority'
             WHEN chronic_condition_count >= 6 OR annual_cost >= 10000 THEN 'Moderate Priority'
             ELSE 'Standard Care' END AS care_priority FROM b2""",
    ),
    "dec_care_pool": (
        decisions.care_pool,
        CARE + "SELECT count(*) AS high_priority_beneficiaries FROM pool",
    ),
    "dec_care_list": (
        decisions.care_list,
        CARE
        + """SELECT beneficiary_id, chronic_condition_count, annual_cost FROM pool
        ORDER BY annual_cost DESC, beneficiary_id LIMIT 5000""",
    ),
    "dec_care_list_series": (
        decisions.care_list_series,
        CARE
        + """, placed AS (SELECT beneficiary_id, chronic_condition_count, annual_cost,
          row_number() OVER o AS enrollment_place, CAST(sum(annual_cost) OVER o AS BIGINT) AS running_cost
          FROM pool WINDOW o AS (ORDER BY annual_cost DESC, beneficiary_id))
        SELECT *, (SELECT min(r.range) FROM range(500, 20001, 500) r WHERE r.range >= enrollment_place)
          AS enrolled_from_capacity FROM placed""",
    ),
    "dec_care_savings": (
        decisions.care_savings,
        CARE
        + """SELECT CAST(coalesce(sum(annual_cost), 0) AS BIGINT) AS enrolled_cost,
        CAST(coalesce(sum(annual_cost), 0) AS BIGINT) * CAST(0.12 AS DOUBLE) AS projected_savings FROM pool""",
    ),
    "dec_disease_counts": (decisions.disease_counts, CARE + _list_counts),
    # --- reference rows applied to the claims ------------------------------------
    "src_calendar": (
        lambda m: lookups.calendar_over(m.fact),
        """, span AS (SELECT CAST(unnest(generate_series(min(claim_start_date), max(claim_start_date),
          INTERVAL 1 DAY)) AS DATE) AS d FROM c)
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
          CAST(day(d) AS INTEGER) AS day_of_month, dayname(d) AS day_name,
          CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS INTEGER) AS week_of_year,
          CAST(month(d) AS INTEGER) AS month_num, monthname(d) AS month_name,
          CAST(quarter(d) AS INTEGER) AS quarter_num, 'Q' || quarter(d) AS quarter_name,
          CAST(year(d) AS INTEGER) AS year_num, strftime(d, '%Y-%m') AS year_month,
          dayofweek(d) IN (0, 6) AS is_weekend FROM span""",
    ),
    "src_series": (
        lambda m: lookups.parameter_series(m.fact.sparkSession, "top_n").join(
            decisions.top_n_providers(m, 50).withColumnRenamed("provider_rank", "top_n"), "top_n"
        ).groupBy("top_n").agg(F.sum("total_reimbursement").alias("total_reimbursement")),
        PROVIDERS
        + """SELECT top_n, CAST(sum(total_reimbursement) AS BIGINT) AS total_reimbursement FROM
        (SELECT *, dense_rank() OVER (ORDER BY total_reimbursement DESC NULLS LAST) AS top_n FROM p)
        WHERE top_n BETWEEN 1 AND 50 GROUP BY top_n""",
    ),
    "src_lookup": (
        lambda m: lookups.conditions(m.fact.sparkSession).join(
            decisions.disease_counts(m), "disease_name"
        ),
        CARE
        + ", l AS ("
        + _list_counts
        + "), o AS ("
        + " UNION ALL ".join(
            f"SELECT {i} AS sort_order, '{row[2].replace(chr(39), chr(39) * 2)}' AS disease_name, '{row[0]}' AS flag_column"
            for i, row in enumerate(CONDITIONS, 1)
        )
        + ") SELECT * FROM l JOIN o USING (disease_name)",
    ),
    "src_metric_switch": (
        lambda m: metrics.switch_values(m, ["provider_id"]),
        SCORES
        + f""", v AS (SELECT provider_id, CAST(count(*) AS DOUBLE) AS a, CAST({total(AMT)} AS DOUBLE) AS b,
          {zero(f'sum({AMT})', 'count(*)')} AS d, {zero(FRAUD_PROVIDERS, 'count(DISTINCT provider_key)')} AS e,
          CAST({rows_if('is_deceased')} AS DOUBLE) AS f FROM c GROUP BY provider_id)
        SELECT provider_id, sort_order, metric_name, CAST(CASE sort_order WHEN 1 THEN a WHEN 2 THEN b WHEN 3 THEN d
          WHEN 4 THEN e WHEN 5 THEN risk_score ELSE f END AS DOUBLE) AS selected_metric
        FROM v JOIN (SELECT provider_id, risk_score FROM q) USING (provider_id)
        CROSS JOIN (VALUES """
        + ", ".join(f"({i}, '{label}')" for i, label in enumerate(metrics.SWITCH, 1))
        + ") AS names(sort_order, metric_name)",
    ),
    # --- report data sets --------------------------------------------------------
    "vis_drill": (
        reports.drill,
        f"""SELECT fraud_label, claim_type, region, age_group,
          grouping(fraud_label, claim_type, region, age_group) AS grouping_level,
          count(*) AS total_claims, {total(AMT)} AS total_reimbursement
        FROM c GROUP BY CUBE (fraud_label, claim_type, region, age_group)""",
    ),
    "vis_label_type_mix": (
        reports.label_type_mix,
        f"""SELECT *, CAST(total_reimbursement AS DOUBLE)
          / sum(total_reimbursement) OVER (PARTITION BY fraud_label) * 100 AS pct_of_label
        FROM (SELECT fraud_label, claim_type, {total(AMT)} AS total_reimbursement FROM c GROUP BY ALL)""",
    ),
    "vis_month_year_pivot": (
        reports.month_year_pivot,
        "SELECT month_num, CASE WHEN month_num IS NULL THEN 'Total' ELSE any_value(month_name) END AS month_name, "
        + ", ".join(
            f"CAST(sum({AMT}) FILTER (WHERE year_num = {y}) AS BIGINT) AS y{y}" for y in range(1995, 2002)
        )
        + f", {total(AMT)} AS total FROM c GROUP BY ROLLUP (month_num)",
    ),
    "vis_los_hist": (
        reports.stay_histogram,
        "SELECT admission_duration_days, count(*) AS total_claims FROM c "
        "WHERE admission_duration_days IS NOT NULL GROUP BY ALL",
    ),
    "vis_code_hist": (
        reports.code_histogram,
        "SELECT provider_id, diagnosis_code_count, count(*) AS total_claims FROM c GROUP BY ALL",
    ),
    "vis_age_gender": (
        reports.age_gender,
        "SELECT age_group, gender, count(DISTINCT beneficiary_key) AS total_beneficiaries FROM c GROUP BY ALL",
    ),
    "vis_state_metric_topn": (
        lambda m: reports.state_metric_top(m, "Fraud Rate %"),
        f"""SELECT state_name, {zero(FRAUD_PROVIDERS, 'count(DISTINCT provider_key)')} AS selected_metric
        FROM c WHERE state_name IS NOT NULL GROUP BY state_name
        ORDER BY selected_metric DESC NULLS LAST, state_name LIMIT 15""",
    ),
    "vis_topn_sets": (
        reports.top_sets,
        SCORES
        + f", st AS (SELECT state_name, {total(AMT)} AS a FROM c WHERE state_name IS NOT NULL GROUP BY state_name) "
        + " UNION ALL ".join(
            [
                top_sql("st", "top 10 states by amount", "state_name", "a", 10),
                top_sql("q", "top 50 providers by amount", "provider_id", "total_reimbursement", 50),
                top_sql("q", "top 100 providers by amount", "provider_id", "total_reimbursement", 100),
                top_sql("q", "top 100 providers by claims", "provider_id", "total_claims", 100),
                top_sql("q", "top 20 providers by codes", "provider_id", "codes", 20),
                top_sql("q", "top 20 providers by score", "provider_id", "risk_score", 20),
            ]
        ),
    ),
    "vis_hold_list": (
        reports.hold_list,
        SCORES
        + """SELECT provider_id, fraud_label, is_potential_fraud, total_claims, total_reimbursement,
        rate AS same_day_discharge_rate, codes AS diagnosis_padding_score, payment_decision FROM q
        WHERE payment_decision = 'Payment Hold'""",
    ),
    "vis_hold_scatter": (
        reports.hold_scatter,
        SCORES
        + """SELECT provider_id, payment_decision, rate AS same_day_discharge_rate,
        codes AS diagnosis_padding_score FROM q
        WHERE payment_decision IN ('Payment Hold', 'Pre-Payment Review')""",
    ),
    "vis_care_list": (
        reports.care_list,
        CARE
        + "SELECT beneficiary_id, chronic_condition_count, annual_cost, 'High Priority' AS care_priority FROM pool",
    ),
    "vis_deceased_list": (
        reports.deceased_list,
        f"""SELECT beneficiary_id, date_of_death, count(*) AS total_claims, {total(AMT)} AS total_reimbursement
        FROM c WHERE is_deceased GROUP BY ALL""",
    ),
    "vis_provider_profile": (
        reports.provider_profile,
        SCORES
        + f"""SELECT provider_id, fraud_label, is_potential_fraud, total_claims, total_reimbursement,
        {SIGNALS}, risk_score, risk_category, payment_decision FROM q""",
    ),
    "vis_provider_months": (
        reports.provider_months,
        f"""SELECT provider_id, year_num, month_num, month_name, year_month, count(*) AS total_claims,
        {total(AMT)} AS total_reimbursement FROM c GROUP BY ALL""",
    ),
    "vis_provider_claims": (
        reports.provider_claims,
        f"""SELECT provider_id, claim_id, claim_start_date, claim_type, {AMT}, claim_duration_days,
        diagnosis_code_count, procedure_code_count, is_same_day_discharge FROM c""",
    ),
    "vis_provider_scatter": (
        reports.provider_scatter,
        f"""SELECT provider_id, fraud_label, count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
        {rows_if('is_deceased')} AS deceased_patient_claims FROM c GROUP BY ALL""",
    ),
    "vis_condition_cost": (
        reports.condition_cost,
        f""", x AS (SELECT age_group, CAST(sum(chronic_condition_count) AS BIGINT) AS condition_sum
          FROM beneficiary GROUP BY ALL),
        y AS (SELECT age_group, {zero(f'sum({AMT})', 'count(DISTINCT beneficiary_key)')} AS avg_reimbursement_per_beneficiary,
          count(*) AS total_claims FROM c GROUP BY ALL)
        SELECT * FROM x LEFT JOIN y USING (age_group)""",
    ),
    "vis_filters": (
        lambda m: reports.sliced(m, SLICE),
        f"""SELECT year_num, month_num, count(*) AS total_claims, {total(AMT)} AS total_reimbursement,
          {zero(FRAUD_PROVIDERS, 'count(DISTINCT provider_key)')} AS fraud_rate,
          {zero(f'sum({AMT})', 'count(*)')} AS avg_reimbursement_per_claim
        FROM c WHERE region IN ('ASIA', 'EUROPE') AND claim_type = 'Outpatient' AND gender = 'Female'
          AND age_group IN ('65+', '55-64') AND fraud_label = 'Not Fraud' GROUP BY ALL""",
    ),
}

ORACLES = {name: STAR + sql for name, (_, sql) in QUERIES.items()}
