"""The provider table that the financial, risk and operational questions share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimward.functions.columns import is_inpatient, is_outpatient, ratio, same_day
from claimward.model import PROVIDER, ClaimsModel
from claimward.session import materialize


def profile(model: ClaimsModel, beneficiaries: bool = False, deceased: bool = True) -> DataFrame:
    """Whole-number totals per provider, from which every average can be derived.

    Kept as sums and counts so that portfolio benchmarks follow from the provider rows
    without a second pass over the claims. Patients are joined for ``deceased`` only;
    provider labels are joined to the finished rows.
    """
    stay = F.when(is_inpatient(), F.col("admission_duration_days")).cast("bigint")
    codes = F.col("diagnosis_code_count").cast("bigint")
    measures = {
        "total_claims": F.count(F.lit(1)),
        "ip_claims": F.count_if(is_inpatient()),
        "op_claims": F.count_if(is_outpatient()),
        "total_reimbursement": F.sum("claim_reimbursement_amt"),
        "paid_claims": F.count("claim_reimbursement_amt"),
        "max_single_claim": F.max("claim_reimbursement_amt"),
        "same_day_discharges": F.count_if(same_day()),
        "same_day_reimbursement": F.coalesce(
            F.sum(F.when(same_day(), F.col("claim_reimbursement_amt"))), F.lit(0).cast("bigint")
        ),
        "code_sum": F.sum(codes),
        "code_claims": F.count(codes),
        "max_diagnosis_codes": F.max("diagnosis_code_count"),
        "claims_with_max_codes": F.count_if(codes == 10),
        "zero_reimbursement_claims": F.count_if("is_zero_reimbursement"),
        "stay_sum": F.sum(stay),
        "stay_square_sum": F.sum(stay * stay),
        "stay_claims": F.count(stay),
        "max_los": F.max(stay).cast("int"),
        "min_los": F.min(stay).cast("int"),
        "extended_stays": F.count_if(stay > 14),
        "extreme_stays": F.count_if(stay > 30),
    }
    if deceased:
        measures["deceased_patient_claims"] = F.count_if("is_deceased")
    if beneficiaries:
        measures["unique_beneficiaries"] = F.count_distinct("beneficiary_key")
    rows = model.joined("beneficiary") if deceased else model.fact
    return (
        rows.groupBy("provider_key")
        .agg(*[expr.alias(name) for name, expr in measures.items()])
        .join(model.providers.select("provider_key", *PROVIDER), "provider_key")
        .withColumns(
            {
                "avg_reimbursement": ratio("total_reimbursement", "paid_claims"),
                "avg_diagnosis_codes": ratio("code_sum", "code_claims"),
                "avg_los": ratio("stay_sum", "stay_claims"),
                "same_day_ratio": ratio("same_day_discharges", "ip_claims"),
            }
        )
    )


def stored_profile(model: ClaimsModel, *needed: str, beneficiaries: bool = False) -> DataFrame:
    """The needed columns of the provider table, computed once."""
    rows = profile(model, beneficiaries, "deceased_patient_claims" in needed)
    return materialize(rows.select("provider_key", *PROVIDER, *needed))


def overall_mean(providers: DataFrame, total: str, rows: str) -> Column:
    """Average over all claims behind the provider rows, as a scalar subquery."""
    return providers.agg(
        F.try_divide(F.sum(total).cast("double"), F.sum(rows).cast("double"))
    ).scalar()
