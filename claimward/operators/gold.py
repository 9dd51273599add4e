"""Star schema: dimensions with surrogate keys, the claim fact, three rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimward.config import CONDITIONS
from claimward.functions.columns import date_key, is_inpatient, is_outpatient
from claimward.functions.ranks import with_rank
from claimward.model import MONTH_KEY, PROVIDER, ClaimsModel, name_months, with_month

UNMAPPED_STATE = -1

BENEFICIARY_COLUMNS = [
    "beneficiary_id",
    "date_of_birth",
    "date_of_death",
    "gender",
    "renal_disease_indicator",
    "state_code",
    "county_code",
    "patient_age",
    "age_group",
    "is_deceased",
    "chronic_condition_count",
    *[flag for flag, _, _ in CONDITIONS],
    "ip_annual_reimbursement_amt",
    "ip_annual_deductible_amt",
    "op_annual_reimbursement_amt",
    "op_annual_deductible_amt",
]


def with_surrogate_key(df: DataFrame, natural: str, key: str) -> DataFrame:
    """Dense numbers in the order of the natural key, assigned without a single-task sort."""
    return with_rank(df, [(natural, "asc")], dense=key)


def dim_provider(stg_provider: DataFrame) -> DataFrame:
    labelled = stg_provider.select(
        "provider_id",
        "is_potential_fraud",
        F.when(F.col("is_potential_fraud"), "Fraud").otherwise("Not Fraud").alias("fraud_label"),
    )
    return with_surrogate_key(labelled, "provider_id", "provider_key")


def dim_beneficiary(stg_beneficiary: DataFrame) -> DataFrame:
    return with_surrogate_key(
        stg_beneficiary.select(*BENEFICIARY_COLUMNS), "beneficiary_id", "beneficiary_key"
    )


def joined_claims(
    stg_claims: DataFrame, provider: DataFrame, beneficiary: DataFrame, geography: DataFrame
) -> DataFrame:
    """Claims that have a provider and a beneficiary, with an optional mapped state."""
    return (
        stg_claims.join(provider, "provider_id")
        .join(beneficiary, "beneficiary_id")
        .join(geography, "state_code", "left")
    )


FACT_COLUMNS = [
    "claim_id",
    "provider_key",
    "beneficiary_key",
    "claim_start_date_key",
    "geo_key",
    "claim_type",
    "is_potential_fraud",
    "claim_reimbursement_amt",
    "deductible_amt_paid",
    "claim_duration_days",
    "admission_duration_days",
    "diagnosis_code_count",
    "procedure_code_count",
    "is_zero_reimbursement",
    "is_same_day_discharge",
]


def fact_claims(
    stg_claims: DataFrame, provider: DataFrame, beneficiary: DataFrame, geography: DataFrame
) -> DataFrame:
    """The fact, keyed by ``claim_id``."""
    wide = joined_claims(
        stg_claims,
        provider.select("provider_id", "provider_key", "is_potential_fraud"),
        beneficiary.select("beneficiary_id", "beneficiary_key", "state_code"),
        geography.select("state_code", "geo_key"),
    ).withColumn("claim_start_date_key", date_key("claim_start_date"))
    return wide.select(*FACT_COLUMNS)


def unmatched_claims(
    stg_claims: DataFrame, provider: DataFrame, beneficiary: DataFrame
) -> DataFrame:
    """How many claims the inner joins of the fact leave out, by reason."""
    known_provider = provider.select("provider_id", F.lit(True).alias("has_provider"))
    known_beneficiary = beneficiary.select("beneficiary_id", F.lit(True).alias("has_beneficiary"))
    no_provider, no_beneficiary = F.col("has_provider").isNull(), F.col("has_beneficiary").isNull()
    return (
        stg_claims.select("provider_id", "beneficiary_id")
        .join(known_provider, "provider_id", "left")
        .join(known_beneficiary, "beneficiary_id", "left")
        .agg(
            F.count_if(no_provider).alias("no_provider"),
            F.count_if(no_beneficiary).alias("no_beneficiary"),
            F.count_if(no_provider | no_beneficiary).alias("dropped_claims"),
        )
    )


def cents(total: Column, rows: Column, kind: str) -> Column:
    """Average rounded half away from zero to two places, in decimal arithmetic."""
    exact = F.try_divide(total.cast("decimal(22,2)"), rows.cast("decimal(12,0)"))
    return F.round(exact, 2).cast(kind)


def _average(name: str, kind: str) -> Column:
    return cents(F.sum(name), F.count(name), kind)


#: Columns of the provider rollup besides the labels.
ROLLUP_MEASURES = [
    "total_claims",
    "total_ip_claims",
    "total_op_claims",
    "total_reimbursement",
    "avg_reimbursement_per_claim",
    "max_reimbursement",
    "total_deductible",
    "unique_beneficiaries",
    "avg_claim_duration_days",
    "avg_admission_duration_days",
    "avg_diagnosis_code_count",
    "avg_procedure_code_count",
    "zero_reimbursement_claims",
    "same_day_discharge_claims",
    "deceased_patient_claims",
    "unique_attending_physicians",
]


def provider_rollup(model: ClaimsModel, stg_claims: DataFrame | None = None) -> DataFrame:
    """Nineteen measures per provider.

    Attending physicians come from all staged claims of the provider when ``stg_claims``
    is given (also those that never reached the fact), otherwise from the model's claims.
    """
    measures = [
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(is_inpatient()).alias("total_ip_claims"),
        F.count_if(is_outpatient()).alias("total_op_claims"),
        F.sum("claim_reimbursement_amt").alias("total_reimbursement"),
        _average("claim_reimbursement_amt", "decimal(12,2)").alias("avg_reimbursement_per_claim"),
        F.max("claim_reimbursement_amt").alias("max_reimbursement"),
        F.sum("deductible_amt_paid").alias("total_deductible"),
        _average("claim_duration_days", "decimal(8,2)").alias("avg_claim_duration_days"),
        _average("admission_duration_days", "decimal(8,2)").alias("avg_admission_duration_days"),
        _average("diagnosis_code_count", "decimal(6,2)").alias("avg_diagnosis_code_count"),
        _average("procedure_code_count", "decimal(6,2)").alias("avg_procedure_code_count"),
        F.count_if("is_zero_reimbursement").alias("zero_reimbursement_claims"),
        F.sum(F.col("is_same_day_discharge").cast("int")).alias("same_day_discharge_claims"),
        F.count_if("is_deceased").alias("deceased_patient_claims"),
    ]
    physicians = F.count_distinct("attending_physician_id").alias("unique_attending_physicians")
    labels = model.providers.select("provider_key", *PROVIDER)
    claims = model.joined("beneficiary")
    if stg_claims is None and "attending_physician_id" in model.fact.columns:
        distinct = [F.count_distinct("beneficiary_key").alias("unique_beneficiaries"), physicians]
        rows = claims.groupBy("provider_key").agg(*measures, *distinct)
        return _in_order(rows.join(labels, "provider_key"), "unique_attending_physicians")
    if stg_claims is not None:
        per_provider = stg_claims.groupBy("provider_id").agg(physicians)
    elif "agg_provider_summary" in model.rollups:  # the stored fact has no physicians
        per_provider = model.rollups["agg_provider_summary"].select(
            "provider_id", "unique_attending_physicians"
        )
    else:
        raise ValueError("physicians come from staged claims or the stored rollup")
    # apart from the measures: beside them every pair of provider and patient would be moved with all of them
    patients = (
        claims.select("provider_key", "beneficiary_key")
        .groupBy("provider_key")
        .agg(F.count_distinct("beneficiary_key").alias("unique_beneficiaries"))
    )
    totals = claims.groupBy("provider_key").agg(*measures).join(patients, "provider_key")
    rows = _in_order(totals.join(labels, "provider_key"))
    return rows.join(per_provider, "provider_id", "left")


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    """Columns of the provider rollup: measures, then labels."""
    measures = [name for name in ROLLUP_MEASURES if name != "unique_attending_physicians"]
    return rows.select(*measures, *more, *PROVIDER)


def mapped_state() -> dict[str, Column]:
    """State columns of a claim; a claim without a mapped state gets a state of its own."""
    return {
        "state_code": F.when(F.col("geo_key").isNull(), UNMAPPED_STATE).otherwise(F.col("state_code")),
        "state_name": F.coalesce("state_name", F.lit("Unmapped")),
        "state_abbr": F.coalesce("state_abbr", F.lit("--")),
        "region": F.coalesce("region", F.lit("Unmapped")),
    }


def state_month_rollup(model: ClaimsModel, counted: DataFrame | None = None) -> DataFrame:
    """Eight measures per state and month; claims without a mapped state get their own row.

    ``counted`` may hold the distinct providers and beneficiaries of every state and month, as
    made from stored key sets; then claims are added up only.
    """
    state = mapped_state()
    distinct = ["unique_providers", "unique_beneficiaries"]
    placed = with_month(model.joined("beneficiary", "state").withColumns(state))
    if counted is not None:
        by = [*state, *MONTH_KEY]
        sums = placed.groupBy(*by).agg(*_state_month_sums())
        rows = sums.join(counted, [sums[c].eqNullSafe(counted[c]) for c in by], "left")
        none = F.lit(0).cast("bigint")
        return name_months(
            rows.select(
                *[sums[c] for c in sums.columns if c != "fraud_provider_claims"],
                *[F.coalesce(counted[c], none).alias(c) for c in distinct],
                "fraud_provider_claims",
            )
        )
    return name_months(
        placed.groupBy(*state, *MONTH_KEY)
        .agg(
            *_state_month_sums()[:-1],
            F.count_distinct("provider_key").alias("unique_providers"),
            F.count_distinct("beneficiary_key").alias("unique_beneficiaries"),
            _state_month_sums()[-1],
        )
    )


def _state_month_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(is_inpatient()).alias("total_ip_claims"),
        F.count_if(is_outpatient()).alias("total_op_claims"),
        F.sum("claim_reimbursement_amt").alias("total_reimbursement"),
        _average("claim_reimbursement_amt", "decimal(12,2)").alias("avg_reimbursement_per_claim"),
        F.count_if("is_potential_fraud").alias("fraud_provider_claims"),
    ]


def unfold_conditions(df: DataFrame, keep: list[str], names: str = "rollup") -> DataFrame:
    """One row per condition a row has: ``disease_name`` next to the kept columns."""
    place = 1 if names == "rollup" else 2
    labels = F.array(
        *[F.when(F.col(row[0]) == 1, F.lit(row[place])) for row in CONDITIONS]
    )
    return df.select(*keep, F.explode(F.array_compact(labels)).alias("disease_name"))


def disease_rollup(model: ClaimsModel) -> DataFrame:
    """Eleven rows. A claim counts once for every condition of its patient.

    Claims are added up per patient before the conditions are unfolded, so the unfolding
    multiplies patients and not claims.
    """
    per_patient = model.fact.groupBy("beneficiary_key").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("claim_reimbursement_amt").alias("amount")
    )
    enrolled = model.beneficiaries.join(per_patient, "beneficiary_key", "left")
    everyone = model.beneficiaries.agg(F.count(F.lit(1))).scalar()
    per_disease = (
        unfold_conditions(enrolled, ["chronic_condition_count", "claims", "amount"])
        .groupBy("disease_name")
        .agg(
            F.count(F.lit(1)).alias("total_beneficiaries"),
            F.sum("claims").alias("total_claims"),
            F.sum("amount").alias("total_reimbursement"),
            F.sum("chronic_condition_count").alias("condition_sum"),
        )
        .filter("total_claims is not null")
    )
    patients = F.col("total_beneficiaries")
    return per_disease.select(
        "disease_name",
        "total_beneficiaries",
        cents(patients * 100, everyone, "decimal(6,2)").alias("pct_of_all_beneficiaries"),
        "total_claims",
        "total_reimbursement",
        cents(F.col("total_reimbursement"), patients, "decimal(12,2)").alias(
            "avg_reimbursement_per_patient"
        ),
        cents(F.col("condition_sum"), patients, "decimal(6,2)").alias(
            "avg_chronic_count_for_patients_with_this"
        ),
    )
