"""Operational efficiency: length of stay, same-day stays, code padding, durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.functions.columns import (
    amount_when,
    choose,
    is_inpatient,
    is_outpatient,
    mean,
    percent,
    ratio,
    same_day,
    share,
    steps,
)
from claimward.functions.ranks import with_rank
from claimward.model import PROVIDER, STATE, ClaimsModel
from claimward.plans.provider import overall_mean, stored_profile

AMOUNT = "claim_reimbursement_amt"


def kpis(model: ClaimsModel) -> DataFrame:
    stay = F.when(is_inpatient(), F.col("admission_duration_days"))
    return model.fact.agg(
        mean(stay).alias("avg_length_of_stay"),
        F.max(stay).alias("max_length_of_stay"),
        F.count_if(same_day()).alias("total_same_day_discharges"),
        percent(F.count_if(same_day()), F.count_if(is_inpatient())).alias(
            "same_day_discharge_rate_pct"
        ),
        mean("diagnosis_code_count").alias("avg_diagnosis_codes_per_claim"),
        F.max("diagnosis_code_count").alias("max_diagnosis_codes"),
        mean("procedure_code_count").alias("avg_procedure_codes_per_claim"),
        F.count_if("is_zero_reimbursement").alias("zero_reimbursement_claims"),
        percent(F.count_if("is_zero_reimbursement"), F.count(F.lit(1))).alias(
            "zero_reimbursement_pct"
        ),
        mean("claim_duration_days").alias("avg_claim_duration_days"),
        F.max("claim_duration_days").alias("max_claim_duration_days"),
    )


def _stay_stats(providers: DataFrame) -> Column:
    """Mean and sample deviation over all stays, from the whole-number provider sums.

    n * sum(x^2) - sum(x)^2 is evaluated in decimals, so nothing cancels.
    """
    n, total, squares = F.sum("stay_claims"), F.sum("stay_sum"), F.sum("stay_square_sum")
    wide = "decimal(38,0)"
    spread = n.cast("decimal(18,0)") * squares.cast("decimal(19,0)") - total.cast(
        "decimal(19,0)"
    ) * total.cast("decimal(18,0)")
    pairs = n.cast("decimal(18,0)") * (n - 1).cast("decimal(19,0)")
    deviation = F.sqrt(F.try_divide(spread.cast(wide).cast("double"), pairs.cast("double")))
    return providers.agg(
        F.struct(ratio(total, n).alias("m"), deviation.alias("s"))
    ).scalar()


def length_of_stay(model: ClaimsModel, min_claims: int = 10) -> DataFrame:
    """Average stay per provider with enough inpatient claims, against all stays."""
    providers = stored_profile(
        model,
        "ip_claims",
        "avg_los",
        "max_los",
        "min_los",
        "extended_stays",
        "extreme_stays",
        "stay_sum",
        "stay_square_sum",
        "stay_claims",
    )
    own, base, spread = F.col("avg_los"), F.col("stats.m"), F.col("stats.s")
    return (
        providers.filter(F.col("ip_claims") >= min_claims)
        .withColumn("stats", _stay_stats(providers))
        .select(
            *PROVIDER,
            "ip_claims",
            "avg_los",
            "max_los",
            "min_los",
            base.alias("global_avg_los"),
            F.round(spread, 6).alias("global_stddev_los"),
            (own - base).alias("vs_avg_los"),
            "extended_stays",
            "extreme_stays",
            choose(
                [
                    (own > base + 2 * spread, "Extreme Outlier (>2 SD)"),
                    (own > base + spread, "Outlier (>1 SD)"),
                ],
                "Normal",
            ).alias("los_anomaly_flag"),
        )
    )


def same_day_providers(model: ClaimsModel, min_claims: int = 5) -> DataFrame:
    """Same-day admissions and discharges per provider with enough inpatient claims."""
    providers = stored_profile(
        model, "ip_claims", "same_day_discharges", "same_day_ratio", "same_day_reimbursement"
    )
    base = overall_mean(providers, "same_day_discharges", "ip_claims")
    ranked = with_rank(
        providers.filter(F.col("ip_claims") >= min_claims),
        [("same_day_discharges", "desc")],
        rank="same_day_rank",
    )
    return (
        ranked.withColumn("global_same_day_rate", base * 100)
        .withColumn("same_day_rate_pct", F.col("same_day_ratio") * 100)
        .select(
            *PROVIDER,
            F.col("ip_claims").alias("total_ip_claims"),
            F.col("same_day_discharges").alias("same_day_count"),
            "same_day_rate_pct",
            "global_same_day_rate",
            (F.col("same_day_rate_pct") - F.col("global_same_day_rate")).alias("vs_benchmark_pct"),
            "same_day_reimbursement",
            steps(
                "same_day_ratio", [(0.15, "High Risk (>15%)"), (0.05, "Elevated (>5%)")], "Normal"
            ).alias("same_day_risk_flag"),
            "same_day_rank",
        )
    )


def code_padding(model: ClaimsModel, min_claims: int = 20) -> DataFrame:
    """Diagnosis codes per claim and provider with enough claims."""
    providers = stored_profile(
        model,
        "total_claims",
        "avg_diagnosis_codes",
        "max_diagnosis_codes",
        "claims_with_max_codes",
        "code_sum",
        "code_claims",
        "total_reimbursement",
    )
    base = overall_mean(providers, "code_sum", "code_claims")
    ranked = with_rank(
        providers.filter(F.col("total_claims") >= min_claims),
        [("avg_diagnosis_codes", "desc")],
        rank="padding_rank",
    )
    return ranked.withColumn("global_avg_diag", base).select(
        *PROVIDER,
        "total_claims",
        "avg_diagnosis_codes",
        "max_diagnosis_codes",
        "claims_with_max_codes",
        percent("claims_with_max_codes", "total_claims").alias("max_code_claims_pct"),
        "global_avg_diag",
        (F.col("avg_diagnosis_codes") - F.col("global_avg_diag")).alias("vs_avg_diag_codes"),
        steps(
            "avg_diagnosis_codes",
            [(9.5, "High Padding Risk"), (9.0, "Elevated"), (8.5, "Moderate")],
            "Normal",
        ).alias("padding_risk_flag"),
        "total_reimbursement",
        "padding_rank",
    )


def state_mix(model: ClaimsModel) -> DataFrame:
    """Inpatient against outpatient per state; the windows run over one row per state."""
    per_state = (
        model.joined("state").filter("geo_key is not null")
        .groupBy(*STATE)
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.count_if(is_inpatient()).alias("ip_claims"),
            F.count_if(is_outpatient()).alias("op_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            amount_when(is_inpatient()).alias("ip_reimbursement"),
            amount_when(is_outpatient()).alias("op_reimbursement"),
            mean(F.when(is_inpatient(), F.col(AMOUNT))).alias("ip_avg_reimbursement"),
            mean(F.when(is_outpatient(), F.col(AMOUNT))).alias("op_avg_reimbursement"),
        )
    )
    nation = Window.partitionBy()
    by_amount = Window.orderBy(F.desc_nulls_last("total_reimbursement"))
    typical = F.avg("ip_op_ratio").over(nation)
    return (
        per_state.withColumn("ip_op_ratio", ratio("ip_claims", "op_claims"))
        .withColumn("ip_reimbursement_pct", percent("ip_reimbursement", "total_reimbursement"))
        .withColumn(
            "vs_national_ip_avg",
            F.round(
                F.col("ip_avg_reimbursement") - F.avg("ip_avg_reimbursement").over(nation), 6
            ),
        )
        .withColumn("typical", typical)
        .withColumn(
            "efficiency_flag",
            choose(
                [
                    (F.col("ip_op_ratio") > F.col("typical") * 1.5, "Inpatient Heavy"),
                    (F.col("ip_op_ratio") > F.col("typical") * 1.2, "Slightly Elevated"),
                ],
                "Normal",
            ),
        )
        .withColumn("state_rank", F.rank().over(by_amount).cast("bigint"))
        .drop("typical")
    )


# Upper day bound and label of each duration bucket.
BUCKETS = [
    (0, "0 days (Same Day)"),
    (3, "1-3 days"),
    (7, "4-7 days"),
    (14, "8-14 days"),
    (30, "15-30 days"),
]
LAST_BUCKET = "30+ days"


def duration_histogram(model: ClaimsModel) -> DataFrame:
    """Claims per duration bucket and type; an unknown duration lands in the last bucket.

    Day counts below zero belong to the second bucket, as only exactly zero is same-day.
    """
    days = F.col("claim_duration_days")

    def inside(bound: int) -> Column:
        return days == 0 if bound == 0 else days <= bound

    label = choose([(inside(b), name) for b, name in BUCKETS], LAST_BUCKET)
    order = choose([(inside(b), i) for i, (b, _) in enumerate(BUCKETS, 1)], len(BUCKETS) + 1)
    return (
        model.fact.groupBy(
            label.alias("duration_bucket"), "claim_type", order.alias("sort_order")
        )
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement"),
        )
        .withColumn("pct_of_total", share("claim_count"))
    )
