"""Text to typed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimward.config import AGE_REFERENCE_DATE, CONDITION_FLAGS
from claimward.functions.columns import (
    INPATIENT,
    OUTPATIENT,
    age_tier,
    choose,
    filled_count,
    number_or_zero,
    text_or_null,
    year_gap,
)
from claimward.operators.tally import union_all
from claimward.schemas import CHRONIC_COLUMNS, CORRUPT, DIAGNOSIS_COLUMNS, PROCEDURE_COLUMNS


def _trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def _date(name: str) -> Column:
    return F.expr(f"try_cast(trim({name}) as date)")


def _int(name: str) -> Column:
    return F.expr(f"try_cast(trim({name}) as int)")


def _label(name: str, known: dict[str, object]) -> Column:
    """Decoded value of a known code, NULL otherwise."""
    text = _trimmed(name)
    return choose([(text == code, value) for code, value in known.items()], None)


def fraud_flag() -> Column:
    return _label("PotentialFraud", {"Yes": True, "No": False})


def provider(raw: DataFrame) -> DataFrame:
    """Labelled providers; rows with an unknown label go to ``provider_rejects``."""
    return raw.select(_trimmed("Provider").alias("provider_id"), fraud_flag().alias("is_potential_fraud")).filter(
        "is_potential_fraud is not null"
    )


def provider_rejects(raw: DataFrame) -> DataFrame:
    return raw.filter(fraud_flag().isNull()).select(
        _trimmed("Provider").alias("provider_id"), F.col("PotentialFraud").alias("label")
    )


def rejects(raw: dict[str, DataFrame]) -> DataFrame:
    """Records that never reach staging: lines the reader could not split, and providers
    with an unknown label."""
    frames = []
    for dataset, df in raw.items():
        kept = df if CORRUPT in df.columns else df.withColumn(CORRUPT, F.lit(None).cast("string"))
        source = F.col("source_file_name") if "source_file_name" in df.columns else F.lit(None).cast("string")
        labels = [(F.col(CORRUPT).isNotNull(), "malformed record", F.col(CORRUPT))]
        if dataset == "provider":
            text = F.concat_ws(",", "Provider", "PotentialFraud")
            labels.append((F.col(CORRUPT).isNull() & fraud_flag().isNull(), "unknown label", text))
        for bad, reason, text in labels:
            frames.append(
                kept.filter(bad).select(
                    F.lit(dataset).alias("dataset"),
                    F.lit(reason).alias("reason"),
                    source.alias("source_file_name"),
                    text.alias("record"),
                )
            )
    return union_all(frames)


def well_formed(raw: DataFrame) -> DataFrame:
    """Records the reader could split."""
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def patient_age(birth: str | Column, reference: str = AGE_REFERENCE_DATE) -> Column:
    return year_gap(birth, F.lit(reference).cast("date"))


def beneficiary(raw: DataFrame, reference: str = AGE_REFERENCE_DATE) -> DataFrame:
    """Typed patients with age, age tier, death flag and number of conditions."""
    flags = [
        F.when(_trimmed(source) == "1", 1).otherwise(0).alias(flag)
        for source, flag in zip(CHRONIC_COLUMNS, CONDITION_FLAGS)
    ]
    typed = raw.select(
        _trimmed("BeneID").alias("beneficiary_id"),
        _date("DOB").alias("date_of_birth"),
        text_or_null("DOD").try_cast("date").alias("date_of_death"),
        _label("Gender", {"1": "Male", "2": "Female"}).alias("gender"),
        _label("RenalDiseaseIndicator", {"Y": 1, "0": 0}).alias("renal_disease_indicator"),
        _int("State").alias("state_code"),
        _int("County").alias("county_code"),
        *flags,
        _int("IPAnnualReimbursementAmt").alias("ip_annual_reimbursement_amt"),
        _int("IPAnnualDeductibleAmt").alias("ip_annual_deductible_amt"),
        _int("OPAnnualReimbursementAmt").alias("op_annual_reimbursement_amt"),
        _int("OPAnnualDeductibleAmt").alias("op_annual_deductible_amt"),
        text_or_null("DOD").isNotNull().alias("is_deceased"),
    )
    total = sum((F.col(flag) for flag in CONDITION_FLAGS[1:]), F.col(CONDITION_FLAGS[0]))
    return (
        typed.withColumn("patient_age", patient_age("date_of_birth", reference))
        .withColumn("age_group", age_tier("patient_age"))
        .withColumn("chronic_condition_count", total)
    )


def _claims(raw: DataFrame, claim_type: str) -> DataFrame:
    """One projection for both claim files; admission data exists for inpatient only."""
    inpatient = claim_type == INPATIENT
    admitted = _date("AdmissionDt") if inpatient else F.lit(None).cast("date")
    discharged = _date("DischargeDt") if inpatient else F.lit(None).cast("date")
    same_day = (
        F.coalesce(admitted == discharged, F.lit(False))
        if inpatient
        else F.lit(None).cast("boolean")
    )
    amount = _int("InscClaimAmtReimbursed")
    started, ended = _date("ClaimStartDt"), _date("ClaimEndDt")
    diagnoses = [
        text_or_null(name).alias(f"diagnosis_code_{i}") for i, name in enumerate(DIAGNOSIS_COLUMNS, 1)
    ]
    procedures = [
        text_or_null(name).alias(f"procedure_code_{i}") for i, name in enumerate(PROCEDURE_COLUMNS, 1)
    ]
    return raw.select(
        _trimmed("ClaimID").alias("claim_id"),
        _trimmed("BeneID").alias("beneficiary_id"),
        _trimmed("Provider").alias("provider_id"),
        F.lit(claim_type).alias("claim_type"),
        started.alias("claim_start_date"),
        ended.alias("claim_end_date"),
        admitted.alias("admission_date"),
        discharged.alias("discharge_date"),
        amount.alias("claim_reimbursement_amt"),
        number_or_zero("DeductibleAmtPaid", "decimal(10,2)").alias("deductible_amt_paid"),
        text_or_null("AttendingPhysician").alias("attending_physician_id"),
        text_or_null("OperatingPhysician").alias("operating_physician_id"),
        text_or_null("OtherPhysician").alias("other_physician_id"),
        *diagnoses,
        *procedures,
        F.date_diff(ended, started).alias("claim_duration_days"),
        F.date_diff(discharged, admitted).alias("admission_duration_days"),
        filled_count(DIAGNOSIS_COLUMNS).alias("diagnosis_code_count"),
        filled_count(PROCEDURE_COLUMNS).alias("procedure_code_count"),
        F.coalesce(amount == 0, F.lit(False)).alias("is_zero_reimbursement"),
        same_day.alias("is_same_day_discharge"),
    )


def inpatient_claims(raw: DataFrame) -> DataFrame:
    return _claims(raw, INPATIENT)


def outpatient_claims(raw: DataFrame) -> DataFrame:
    return _claims(raw, OUTPATIENT)


def claims(raw_inpatient: DataFrame, raw_outpatient: DataFrame) -> DataFrame:
    return inpatient_claims(raw_inpatient).unionByName(outpatient_claims(raw_outpatient))


def silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging tables from the four raw frames (quotes already stripped)."""
    return {
        "stg_provider": provider(raw["provider"]),
        "stg_beneficiary": beneficiary(raw["beneficiary"]),
        "stg_claims": claims(raw["inpatient"], raw["outpatient"]),
    }
