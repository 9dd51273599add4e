"""Population health: patient mix, high utilizers, disease burden, deceased patients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.functions.columns import (
    is_inpatient,
    is_outpatient,
    mean,
    percent,
    ratio,
    relative,
    share,
    whole_div,
)
from claimward.functions.ranks import first_tile, with_rank
from claimward.model import ClaimsModel
from claimward.operators.gold import disease_rollup
from claimward.session import materialize

AMOUNT = "claim_reimbursement_amt"
PATIENT = ["beneficiary_id", "date_of_birth", "date_of_death", "patient_age", "gender", "state_code"]


def _population(rows: DataFrame, rows_per_patient: bool) -> DataFrame:
    """Indicators over the given rows; ``weight`` is the number of claims of a row."""
    patients = F.count(F.lit(1)) if rows_per_patient else F.count_distinct("beneficiary_key")
    return rows.agg(
        patients.alias("total_beneficiaries"),
        mean("chronic_condition_count").alias("avg_chronic_conditions"),
        mean("patient_age").alias("avg_patient_age"),
        F.count_if("is_deceased").alias("deceased_beneficiaries"),
        percent(F.count_if("is_deceased"), patients).alias("deceased_pct"),
        F.coalesce(F.sum(F.when(F.col("is_deceased"), F.col("weight"))), F.lit(0).cast("bigint")).alias(
            "claims_from_deceased"
        ),
        F.count_if(F.col("gender") == "Male").alias("male_beneficiaries"),
        F.count_if(F.col("gender") == "Female").alias("female_beneficiaries"),
    )


def kpis(model: ClaimsModel, grain: str = "beneficiary") -> DataFrame:
    """Population indicators over patients with claims.

    ``grain='claim'`` weighs every patient by the number of claims, which is how the
    original one-row report counted everything except the number of beneficiaries.
    """
    traits = ["chronic_condition_count", "patient_age", "is_deceased", "gender"]
    if grain == "claim":
        one = F.lit(1).cast("bigint")
        return _population(model.joined("beneficiary").withColumn("weight", one), rows_per_patient=False)
    if grain != "beneficiary":
        raise ValueError(f"unknown grain {grain!r}")
    # claims are counted per key first: a patient with most of them is one row in the join
    per_key = model.fact.groupBy("beneficiary_key").agg(F.count(F.lit(1)).alias("weight"))
    patients = per_key.join(
        model.beneficiaries.select("beneficiary_key", *traits), "beneficiary_key"
    )
    return _population(patients, rows_per_patient=True)


def high_utilizers(model: ClaimsModel) -> DataFrame:
    """Count, sum and average of the costliest tenth of patients."""
    totals = model.fact.groupBy("beneficiary_key").agg(F.sum(AMOUNT).alias("total_reimb"))
    return first_tile(totals, "total_reimb", 10).select(
        F.col("tile_rows").alias("high_utilizer_count"),
        F.col("tile_sum").alias("high_utilizer_reimbursement"),
        F.col("tile_mean").alias("avg_high_utilizer_reimbursement"),
    )


def age_gender(model: ClaimsModel) -> DataFrame:
    return (
        model.joined("beneficiary").filter("gender is not null and age_group is not null")
        .groupBy("age_group", "gender")
        .agg(
            F.count_distinct("beneficiary_key").alias("beneficiary_count"),
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement_per_claim"),
            mean("chronic_condition_count").alias("avg_chronic_conditions"),
        )
        .withColumn("avg_cost_per_beneficiary", whole_div("total_reimbursement", "beneficiary_count"))
        .withColumn("avg_claims_per_beneficiary", ratio("total_claims", "beneficiary_count"))
        .withColumn("pct_of_total_reimbursement", share("total_reimbursement"))
    )


def disease_burden(model: ClaimsModel) -> DataFrame:
    """Ranks and scores over the eleven disease rows, the stored ones where there are."""
    everything = Window.partitionBy()
    per_patient = F.col("avg_reimbursement_per_patient").cast("double")

    def place(name: str) -> Column:
        return F.rank().over(Window.orderBy(F.desc_nulls_last(name))).cast("bigint")

    def half(value: Column) -> Column:
        return ratio(value, F.max(value).over(everything)) * 50

    stored = model.rollups.get("agg_chronic_disease")
    return (disease_rollup(model) if stored is None else stored).withColumns(
        {
            "cost_rank": place("total_reimbursement"),
            "prevalence_rank": place("total_beneficiaries"),
            "cost_per_patient_rank": place("avg_reimbursement_per_patient"),
            "cost_intensity_pct": F.round(
                percent(per_patient, F.avg(per_patient).over(everything)), 6
            ),
            "prevention_opportunity_score": F.round(
                half(F.col("total_beneficiaries")) + half(per_patient), 6
            ),
        }
    )


def utilizer_profile(model: ClaimsModel) -> DataFrame:
    """Patients at or above mean + 1 sd of patient totals, with their conditions."""
    totals = materialize(
        model.fact.groupBy("beneficiary_key").agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            F.count_distinct("provider_key").alias("unique_providers"),
            F.count_if(is_inpatient()).alias("ip_claims"),
            F.count_if(is_outpatient()).alias("op_claims"),
            mean("claim_duration_days").alias("avg_claim_duration"),
        )
    )
    stats = totals.agg(
        F.struct(
            mean("total_reimbursement").alias("m"),
            F.stddev_samp("total_reimbursement").alias("s"),
        )
    ).scalar()
    total = F.col("total_reimbursement")
    high = (
        totals.withColumn("stats", stats)
        .filter(total >= F.col("stats.m") + F.col("stats.s"))
        .withColumn("avg_beneficiary_reimbursement", F.col("stats.m"))
        .withColumn("upper", F.col("stats.m") + 2 * F.col("stats.s"))
        .drop("stats")
    )
    ranked = with_rank(high, [("total_reimbursement", "desc")], rank="utilizer_rank")
    traits = [
        "beneficiary_id",
        "age_group",
        "gender",
        "patient_age",
        "is_deceased",
        "chronic_condition_count",
        "state_code",
        "has_alzheimer",
        "has_heart_failure",
        "has_kidney_disease",
        "has_cancer",
        "has_diabetes",
        "has_depression",
        "has_stroke",
    ]
    return ranked.join(model.beneficiaries.select("beneficiary_key", *traits), "beneficiary_key").select(
        *traits,
        "total_claims",
        "total_reimbursement",
        "unique_providers",
        "ip_claims",
        "op_claims",
        "avg_claim_duration",
        "avg_beneficiary_reimbursement",
        F.round("upper", 6).alias("mean_plus_2sd"),
        F.when(total >= F.col("upper"), "High Utilizer (>= mean + 2 SD)")
        .otherwise("Moderate Utilizer (>= mean + 1 SD)")
        .alias("utilizer_tier"),
        relative(total, "avg_beneficiary_reimbursement").alias("vs_avg_pct"),
        "utilizer_rank",
    )


def deceased_claims(model: ClaimsModel) -> DataFrame:
    """Claims of deceased patients: all of them, and those that start after the death."""
    day = F.col("claim_start_date")
    return (
        model.joined("beneficiary").filter("is_deceased")
        .groupBy("beneficiary_key", *PATIENT)
        .agg(
            F.count(F.lit(1)).alias("deceased_patient_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            F.min(day).alias("first_claim_date"),
            F.max(day).alias("last_claim_date"),
            F.count_distinct("provider_key").alias("unique_providers"),
            F.count_if(day > F.col("date_of_death")).alias("claims_started_after_death"),
            F.expr("count(distinct provider_key) filter (where is_potential_fraud)").alias(
                "fraud_providers_involved"
            ),
        )
        .withColumn("days_after_death_first_claim", F.date_diff("first_claim_date", "date_of_death"))
        .drop("beneficiary_key")
    )


# Conditions named in a combination, in this order.
COMBINED = [
    ("has_diabetes", "Diabetes "),
    ("has_heart_failure", "Heart Failure "),
    ("has_ischemic_heart", "Ischemic Heart "),
    ("has_kidney_disease", "Kidney Disease "),
    ("has_depression", "Depression "),
]


def cooccurrence(model: ClaimsModel, min_patients: int = 100) -> DataFrame:
    """Condition combinations of patients with three or more conditions."""
    text = F.concat(*[F.when(F.col(flag) == 1, name).otherwise("") for flag, name in COMBINED])
    return (
        model.joined("beneficiary").filter("chronic_condition_count >= 3")
        .withColumn("condition_combination", text)
        .groupBy("condition_combination", "chronic_condition_count")
        .agg(
            F.count_distinct("beneficiary_key").alias("beneficiary_count"),
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement_per_claim"),
        )
        .filter(F.col("beneficiary_count") >= min_patients)
        .withColumn("cost_per_beneficiary", whole_div("total_reimbursement", "beneficiary_count"))
    )
