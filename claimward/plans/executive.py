"""Portfolio overview: totals, monthly trend, splits, leading states, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window, WindowSpec

from claimward.functions.columns import (
    amount_when,
    choose,
    is_inpatient,
    is_outpatient,
    mean,
    percent,
    relative,
    share,
    whole_div,
)
from claimward.model import MONTH_KEY, STATE, ClaimsModel, name_months, with_month

AMOUNT = "claim_reimbursement_amt"


def flagged() -> Column:
    return F.col("is_potential_fraud")


def distinct_flagged() -> Column:
    """Flagged providers, as a filter on the same distinct column as the provider count.

    A separate distinct expression would repeat every claim once more in memory.
    """
    return F.expr("count(distinct provider_key) filter (where is_potential_fraud)")


def portfolio(model: ClaimsModel) -> DataFrame:
    """One row of headline numbers.

    The fraud rate counts each flagged provider once; ``fraud_claims`` is the number of
    their claims.
    """
    totals = model.joined("beneficiary").agg(
        F.count_distinct("provider_key").alias("total_providers"),
        F.count_distinct("beneficiary_key").alias("total_beneficiaries"),
        F.count(F.lit(1)).alias("total_claims"),
        F.sum(AMOUNT).alias("total_reimbursement"),
        mean(AMOUNT).alias("avg_reimbursement_per_claim"),
        F.sum("deductible_amt_paid").cast("double").alias("total_deductible"),
        distinct_flagged().alias("fraud_providers"),
        F.count_if(flagged()).alias("fraud_claims"),
        amount_when(flagged()).alias("fraud_reimbursement"),
        F.sum(F.col("is_same_day_discharge").cast("int")).alias("same_day_discharge_count"),
        F.count_if("is_deceased").alias("deceased_patient_claims"),
        F.count_if("is_zero_reimbursement").alias("zero_reimbursement_claims"),
        mean("claim_duration_days").alias("avg_claim_duration_days"),
        mean(F.when(is_inpatient(), F.col("admission_duration_days"))).alias("avg_admission_days"),
    )
    return totals.withColumns(
        {
            "fraud_rate_pct": percent("fraud_providers", "total_providers"),
            "fraud_reimbursement_pct": percent("fraud_reimbursement", "total_reimbursement"),
        }
    )


def monthly_totals(model: ClaimsModel) -> DataFrame:
    """One row per month that has claims."""
    months = (
        with_month(model.fact)
        .groupBy(*MONTH_KEY)
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            F.count_if(is_inpatient()).alias("ip_claims"),
            F.count_if(is_outpatient()).alias("op_claims"),
            amount_when(flagged()).alias("fraud_reimbursement"),
            F.count_distinct("provider_key").alias("active_providers"),
        )
    )
    return name_months(months)


def by_month() -> WindowSpec:
    """Order of a month table: twelve rows a year, so one task may sort it."""
    return Window.orderBy("year_num", "month_num")


def rolling_mean(value: str) -> Column:
    return F.avg(value).over(by_month().rowsBetween(-2, 0))


def running_total(value: str) -> Column:
    return F.sum(value).over(by_month().rowsBetween(Window.unboundedPreceding, 0))


def monthly_trend(model: ClaimsModel) -> DataFrame:
    return (
        monthly_totals(model)
        .withColumn("prev_month_reimbursement", F.lag("total_reimbursement").over(by_month()))
        .withColumn(
            "reimbursement_mom_pct", relative("total_reimbursement", "prev_month_reimbursement")
        )
        .withColumn("cumulative_reimbursement", running_total("total_reimbursement"))
        .withColumn("rolling_3m_avg_reimbursement", rolling_mean("total_reimbursement"))
    )


def claim_type_split(model: ClaimsModel) -> DataFrame:
    return (
        model.fact.groupBy("claim_type")
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement"),
            mean("claim_duration_days").alias("avg_claim_duration"),
            F.sum("deductible_amt_paid").cast("double").alias("total_deductible"),
            F.count_distinct("provider_key").alias("unique_providers"),
            F.count_distinct("beneficiary_key").alias("unique_beneficiaries"),
        )
        .withColumn("claims_pct", share("total_claims"))
        .withColumn("reimbursement_pct", share("total_reimbursement"))
    )


def fraud_comparison(model: ClaimsModel) -> DataFrame:
    return (
        model.joined("provider", "beneficiary").groupBy("fraud_label", "is_potential_fraud")
        .agg(
            F.count_distinct("provider_key").alias("provider_count"),
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement_per_claim"),
            mean("claim_duration_days").alias("avg_claim_duration"),
            F.count_if("is_deceased").alias("deceased_patient_claims"),
            F.sum(F.col("is_same_day_discharge").cast("int")).alias("same_day_discharges"),
            mean("diagnosis_code_count").alias("avg_diagnosis_codes"),
        )
        .withColumn(
            "avg_reimbursement_per_provider", whole_div("total_reimbursement", "provider_count")
        )
        .withColumn("avg_claims_per_provider", whole_div("total_claims", "provider_count"))
    )


def top_states(model: ClaimsModel, limit: int = 10) -> DataFrame:
    """Leading states by amount; ``fraud_providers`` counts each provider once."""
    per_state = (
        model.joined("state").filter("geo_key is not null")
        .groupBy(*STATE)
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.count_distinct("provider_key").alias("unique_providers"),
            F.count_distinct("beneficiary_key").alias("unique_beneficiaries"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement_per_claim"),
            amount_when(flagged()).alias("fraud_reimbursement"),
            distinct_flagged().alias("fraud_providers"),
            F.count_if(flagged()).alias("fraud_claims"),
        )
    )
    leading = per_state.orderBy(F.desc_nulls_last("total_reimbursement"), "state_name").limit(limit)
    by_amount = Window.orderBy(F.desc_nulls_last("total_reimbursement"))
    return leading.withColumn("reimbursement_rank", F.rank().over(by_amount).cast("bigint"))


def alerts(model: ClaimsModel) -> DataFrame:
    """Rows only for indicators beyond their bound."""
    facts = model.joined("beneficiary").agg(
        percent(distinct_flagged(), F.count_distinct("provider_key")).alias("fraud_rate"),
        F.count_if("is_deceased").alias("deceased"),
        F.coalesce(F.sum(F.col("is_same_day_discharge").cast("int")), F.lit(0)).alias("same_day"),
    )
    rate, deceased, same_day = F.col("fraud_rate"), F.col("deceased"), F.col("same_day")

    def row(name: str, value: Column, status: Column, message: Column) -> Column:
        return F.struct(
            F.lit(name).alias("kpi_name"),
            value.cast("double").alias("kpi_value"),
            status.alias("rag_status"),
            message.alias("alert_message"),
        )

    rows = F.array(
        row(
            "Fraud Rate",
            F.round(rate, 2),
            choose([(rate > 12, "RED"), (rate > 8, "AMBER")], "GREEN"),
            F.when(rate > 12, "Fraud rate exceeds 12% critical threshold").when(
                rate > 8, "Fraud rate exceeds 8% monitoring threshold"
            ),
        ),
        row(
            "Deceased Patient Claims",
            deceased,
            choose([(deceased > 0, "RED")], "GREEN"),
            F.concat(deceased.cast("string"), F.lit(" claims found for deceased beneficiaries")),
        ),
        row(
            "Same Day Discharge",
            same_day,
            choose([(same_day > 1000, "RED"), (same_day > 500, "AMBER")], "GREEN"),
            F.concat(same_day.cast("string"), F.lit(" same-day admissions detected")),
        ),
    )
    return facts.select(F.inline(rows)).filter("rag_status <> 'GREEN'")
