"""Provider risk: five-factor score, tiers, investigation queue, timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.config import LOWEST_TIER, RISK_TIERS, STANDARD, STRICT, RiskThresholds
from claimward.functions.columns import mean, relative, same_day, share, steps
from claimward.functions.ranks import with_rank
from claimward.model import MONTH_KEY, PROVIDER, ClaimsModel, name_months, with_month
from claimward.operators.gold import ROLLUP_MEASURES, provider_rollup
from claimward.plans.provider import overall_mean, stored_profile
from claimward.session import materialize

ROLLUP = [*PROVIDER, *ROLLUP_MEASURES]
FACTORS = [
    "reimbursement_signal",
    "deceased_signal",
    "same_day_signal",
    "padding_signal",
    "fraud_label_signal",
]


def factor_columns(limits: RiskThresholds) -> dict[str, Column]:
    """The five factors; an unknown ratio scores nothing."""
    average, base = F.col("avg_reimbursement"), F.col("global_avg_reimbursement")
    high, medium, low = limits.reimbursement
    reimbursement = (
        F.when(average > base * high, 3)
        .when(average > base * medium, 2)
        .when(average > base * low, 1)
        .otherwise(0)
    )
    return {
        "reimbursement_signal": reimbursement,
        "deceased_signal": steps(
            "deceased_patient_claims", list(zip(limits.deceased, (3, 2, 1))), 0
        ),
        "same_day_signal": steps("same_day_ratio", list(zip(limits.same_day, (2, 1))), 0),
        "padding_signal": steps("avg_diagnosis_codes", list(zip(limits.padding, (2, 1))), 0),
        "fraud_label_signal": F.when(F.col("is_potential_fraud"), limits.label_points).otherwise(0),
    }


def tier(score: str) -> Column:
    return steps(score, [(bound - 1, name) for bound, name in RISK_TIERS], LOWEST_TIER)


def tier_order(score: str) -> Column:
    return steps(
        score, [(bound - 1, place) for place, (bound, _) in enumerate(RISK_TIERS, 1)], 5
    )


def scored(
    model: ClaimsModel, limits: RiskThresholds = STANDARD, beneficiaries: bool = False
) -> DataFrame:
    """One row per provider with factors, score and score without the label factor."""
    needed = [
        "total_claims",
        "ip_claims",
        "op_claims",
        "total_reimbursement",
        "paid_claims",
        "avg_reimbursement",
        "max_single_claim",
        "deceased_patient_claims",
        "same_day_discharges",
        "same_day_ratio",
        "code_sum",
        "code_claims",
        "avg_diagnosis_codes",
        "zero_reimbursement_claims",
    ] + (["unique_beneficiaries"] if beneficiaries else [])
    providers = stored_profile(model, *needed, beneficiaries=beneficiaries)
    total = sum((F.col(name) for name in FACTORS[1:]), F.col(FACTORS[0]))
    return (
        providers.withColumn(
            "global_avg_reimbursement",
            overall_mean(providers, "total_reimbursement", "paid_claims"),
        )
        .withColumns(factor_columns(limits))
        .withColumn("risk_score", total)
        .withColumn("evidence_score", F.col("risk_score") - F.col("fraud_label_signal"))
        .withColumn("risk_category", tier("risk_score"))
    )


def factors(model: ClaimsModel, limits: RiskThresholds = STANDARD) -> DataFrame:
    """Factor values of every provider."""
    return scored(model, limits).select(*PROVIDER, *FACTORS, "risk_score", "evidence_score")


def tiers(model: ClaimsModel) -> DataFrame:
    """Tier of every provider."""
    return scored(model).select("provider_id", "risk_score", "risk_category")


def watchlist(model: ClaimsModel) -> DataFrame:
    """Investigation queue: highest score first, then highest amount."""
    providers = scored(model, beneficiaries=True)
    queue = with_rank(
        providers,
        [("risk_score", "desc"), ("total_reimbursement", "desc")],
        rank="investigation_priority",
    )
    return queue.select(
        *PROVIDER,
        "risk_score",
        "risk_category",
        "total_claims",
        "unique_beneficiaries",
        "ip_claims",
        "op_claims",
        "total_reimbursement",
        "avg_reimbursement",
        "global_avg_reimbursement",
        F.round(relative("avg_reimbursement", "global_avg_reimbursement"), 2).alias(
            "vs_benchmark_pct"
        ),
        "deceased_patient_claims",
        "same_day_discharges",
        F.round(F.col("same_day_ratio") * 100, 2).alias("same_day_discharge_pct"),
        F.round("avg_diagnosis_codes", 2).alias("avg_diagnosis_codes"),
        "max_single_claim",
        "zero_reimbursement_claims",
        "investigation_priority",
    )


def tier_summary(model: ClaimsModel, mode: str = "full") -> DataFrame:
    """Providers, amount and share per tier.

    ``mode='two_factor'`` scores only the amount and the label, as the original tier
    table did; the default uses the full score, so that it agrees with the watchlist.
    """
    providers = scored(model)
    if mode == "two_factor":
        providers = providers.withColumn(
            "risk_score", F.col("reimbursement_signal") + F.col("fraud_label_signal")
        )
    elif mode != "full":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        providers.groupBy(
            tier("risk_score").alias("risk_category"), tier_order("risk_score").alias("sort_order")
        )
        .agg(
            F.count(F.lit(1)).alias("provider_count"),
            F.sum("total_reimbursement").alias("total_reimbursement"),
        )
        .withColumn("pct_of_providers", share("provider_count"))
    )


def signal_breakdown(model: ClaimsModel, limit: int = 30) -> DataFrame:
    """Highest scores under the strict bounds, factor by factor."""
    return (
        scored(model, STRICT)
        .select(
            "provider_id",
            "fraud_label",
            *FACTORS,
            F.col("risk_score").alias("total_risk_score"),
            "total_reimbursement",
        )
        .orderBy(
            F.desc("total_risk_score"), F.desc_nulls_last("total_reimbursement"), "provider_id"
        )
        .limit(limit)
    )


def timeline(model: ClaimsModel) -> DataFrame:
    """Provider by month with the change against the provider's previous month."""
    months = (
        with_month(model.joined("beneficiary"))
        .groupBy("provider_key", *MONTH_KEY)
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum("claim_reimbursement_amt").alias("total_reimbursement"),
            mean("claim_reimbursement_amt").alias("avg_reimbursement"),
            F.count_distinct("beneficiary_key").alias("unique_beneficiaries"),
            F.count_if("is_deceased").alias("deceased_claims"),
            F.count_if(same_day()).alias("same_day_discharges"),
            mean("diagnosis_code_count").alias("avg_diagnosis_codes"),
        )
    )
    labels = model.providers.select("provider_key", "provider_id", "fraud_label")
    monthly = name_months(months).join(labels, "provider_key").drop("provider_key")
    # at most twelve rows per provider and year
    own_months = Window.partitionBy("provider_id").orderBy("year_num", "month_num")
    return monthly.withColumn(
        "prev_month_reimbursement", F.lag("total_reimbursement").over(own_months)
    ).withColumn("reimbursement_mom_pct", relative("total_reimbursement", "prev_month_reimbursement"))


def top_profile(model: ClaimsModel, limit: int = 20) -> DataFrame:
    """Largest providers of the rollup against the average over all claims.

    The stored rollup is read where the model has it.
    """
    stored = model.rollups.get("agg_provider_summary")
    rollup = materialize(provider_rollup(model)) if stored is None else stored.select(*ROLLUP)
    base = model.fact.agg(mean("claim_reimbursement_amt")).scalar()
    ranked = with_rank(rollup, [("deceased_patient_claims", "desc")], rank="deceased_rank")
    ranked = with_rank(ranked, [("same_day_discharge_claims", "desc")], rank="same_day_rank")
    leading = ranked.orderBy(F.desc_nulls_last("total_reimbursement"), "provider_id").limit(limit)
    by_amount = Window.orderBy(F.desc_nulls_last("total_reimbursement"))  # rows already limited
    return (
        leading.withColumn("global_avg_reimbursement", base)
        .withColumn(
            "vs_benchmark_pct",
            relative(F.col("avg_reimbursement_per_claim").cast("double"), "global_avg_reimbursement"),
        )
        .withColumn("reimbursement_rank", F.rank().over(by_amount).cast("bigint"))
        .drop("total_deductible")
    )
