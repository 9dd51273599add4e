"""What-if runs and decision lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


from claimward.functions.columns import choose
from claimward.functions.ranks import running_totals, stepped_totals, with_rank
from claimward.model import PROVIDER, ClaimsModel, with_month
from claimward.operators.gold import unfold_conditions
from claimward.operators.metrics import Filters, filtered, metrics, provider_scores
from claimward.plans.financial import cap_grid
from claimward.session import materialize
from claimward.sources.lookups import SERIES, conditions, parameter_series

REVIEWED = ["Payment Hold", "Pre-Payment Review"]
AVOIDABLE_SHARE = 0.12  # fixed value: part of the annual cost that care management saves
MIN_CONDITIONS, MIN_ANNUAL_COST = 6, 10000  # fixed values of the enrolment rule
HIGH_PRIORITY = "High Priority"


# --- what-if -------------------------------------------------------------------------


def cap_effect(model: ClaimsModel, cap: int = 20000) -> DataFrame:
    """Amount, saving and claims affected if no claim were paid above ``cap``."""
    return cap_grid(model, [cap])


def cap_series(model: ClaimsModel) -> DataFrame:
    """The whole cap series at once: 5,000 to 50,000 in steps of 5,000."""
    return cap_grid(model, list(range(5000, 50001, 5000)))


def threshold_effect(model: ClaimsModel, threshold: int = 6) -> DataFrame:
    """Providers at or above a score and the amount they received."""
    above = F.col("risk_score") >= threshold
    return provider_scores(model).agg(
        F.count_if(above).alias("providers_above_threshold"),
        F.coalesce(F.sum(F.when(above, F.col("total_reimbursement"))), F.lit(0).cast("bigint")).alias(
            "at_risk_reimbursement"
        ),
    )


def threshold_series(model: ClaimsModel) -> DataFrame:
    """The same for every threshold of the series 1..15.

    Providers are added up per score first; each of the at most sixteen score rows then
    counts for all thresholds up to its score.
    """
    per_score = (
        provider_scores(model)
        .groupBy("risk_score")
        .agg(
            F.count(F.lit(1)).alias("providers"), F.sum("total_reimbursement").alias("amount")
        )
    )
    reached = (
        per_score.filter("risk_score >= 1")
        .withColumn("threshold", F.explode(F.sequence(F.lit(1), F.col("risk_score"))))
        .groupBy("threshold")
        .agg(F.sum("providers").alias("providers"), F.sum("amount").alias("amount"))
    )
    thresholds = parameter_series(model.fact.sparkSession, "risk_threshold").select(
        F.col("risk_threshold").cast("int").alias("threshold")
    )
    zero = F.lit(0).cast("bigint")
    return thresholds.join(reached, "threshold", "left").select(
        "threshold",
        F.coalesce("providers", zero).alias("providers_above_threshold"),
        F.coalesce("amount", zero).alias("at_risk_reimbursement"),
    )


# --- providers -----------------------------------------------------------------------


def top_n_providers(model: ClaimsModel, n: int = 0) -> DataFrame:
    """Providers within the first ``n`` distinct amounts; equal amounts share a place."""
    totals = metrics(model, ["total_reimbursement"], list(PROVIDER))
    ranked = with_rank(totals, [("total_reimbursement", "desc")], dense="provider_rank")
    return ranked.filter(F.col("provider_rank") <= n).withColumn("top_n_flag", F.lit(1))


def payment_holds(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Payment decision of every provider."""
    return provider_scores(model, filters).select(
        *PROVIDER,
        "total_claims",
        "total_reimbursement",
        "same_day_discharge_rate",
        "diagnosis_padding_score",
        "payment_decision",
    )


def under_review_amount(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    reviewed = F.col("payment_decision").isin(*REVIEWED)
    return provider_scores(model, filters).agg(
        F.count_if(reviewed).alias("providers_under_review"),
        F.coalesce(F.sum(F.when(reviewed, F.col("total_reimbursement"))), F.lit(0).cast("bigint")).alias(
            "under_review_amount"
        ),
    )


# --- care management -----------------------------------------------------------------


def in_scope(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Patients with at least one claim under the filters, one row each."""
    return filtered(with_month(model.claims_with(filters or ())), filters).select("beneficiary_key").distinct()


def annual_cost() -> Column:
    return F.coalesce("ip_annual_reimbursement_amt", F.lit(0)) + F.coalesce(
        "op_annual_reimbursement_amt", F.lit(0)
    )


def care_priority(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Care-management priority of every patient, from conditions and annual cost."""
    many = F.col("chronic_condition_count") >= MIN_CONDITIONS
    costly = F.col("annual_cost") >= MIN_ANNUAL_COST
    marked = in_scope(model, filters).withColumn("has_claims", F.lit(True))
    return (
        model.beneficiaries.withColumn("annual_cost", annual_cost())
        .join(marked, "beneficiary_key", "left")
        .withColumn(
            "care_priority",
            choose(
                [
                    (F.col("has_claims").isNull(), "No Claims in Scope"),
                    (many & costly, HIGH_PRIORITY),
                    (many | costly, "Moderate Priority"),
                ],
                "Standard Care",
            ),
        )
        .select("beneficiary_id", "chronic_condition_count", "annual_cost", "care_priority")
    )


def high_priority(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Patients to enrol: the rule is applied before the claims are looked up."""
    pool = model.beneficiaries.withColumn("annual_cost", annual_cost()).filter(
        (F.col("chronic_condition_count") >= MIN_CONDITIONS)
        & (F.col("annual_cost") >= MIN_ANNUAL_COST)
    )
    return pool.join(in_scope(model, filters), "beneficiary_key", "left_semi").select(
        "beneficiary_id", "chronic_condition_count", "annual_cost"
    )


def care_pool(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return high_priority(model, filters).agg(
        F.count(F.lit(1)).alias("high_priority_beneficiaries")
    )


def care_savings(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Projected saving: a fixed share of the annual cost of the pool."""
    cost = F.coalesce(F.sum("annual_cost"), F.lit(0).cast("bigint"))
    return high_priority(model, filters).agg(
        cost.alias("enrolled_cost"), (cost * AVOIDABLE_SHARE).alias("projected_savings")
    )


def care_capacity(
    model: ClaimsModel, capacity: int = 5000, filters: Filters | None = None
) -> DataFrame:
    """How many of the pool can be enrolled with the given staffing."""
    pool = F.count(F.lit(1))
    return high_priority(model, filters).agg(
        pool.alias("pool_size"),
        F.least(F.lit(capacity).cast("bigint"), pool).alias("recommended_enrollment"),
    )


def care_capacity_series(
    model: ClaimsModel,
    filters: Filters | None = None,
    series: tuple[int, int, int] = SERIES["care_manager_capacity"],
) -> DataFrame:
    """Enrolment, cost and saving at every staffing of the series, costliest patients first.

    One pass over the pool: its costs are added up in falling order, and each capacity reads
    its total where it falls. A capacity beyond the pool enrols all of it.
    """
    first, last, step = series
    pool = materialize(high_priority(model, filters).select("annual_cost"))
    reached = stepped_totals(
        pool.withColumn("cost", F.col("annual_cost")), ("annual_cost", "desc"), "cost", first, last, step
    )
    whole = pool.agg(
        F.count(F.lit(1)).alias("pool_size"),
        F.coalesce(F.sum("annual_cost"), F.lit(0).cast("bigint")).alias("pool_cost"),
        F.min("annual_cost").alias("least_cost"),
    )
    size, cost, least = (whole.select(c).scalar() for c in whole.columns)
    capacities = model.fact.sparkSession.range(first, last + 1, step).withColumnRenamed("id", "n")
    total = F.coalesce("value_total", cost)
    return capacities.join(reached, "n", "left").select(
        F.col("n").alias("care_manager_capacity"),
        size.alias("pool_size"),
        F.least("n", size).alias("recommended_enrollment"),
        total.alias("enrolled_cost"),
        (total * AVOIDABLE_SHARE).alias("projected_savings"),
        F.when(F.least("n", size) > 0, F.coalesce("at_key", least)).alias("lowest_enrolled_cost"),
    )


def care_list_series(
    model: ClaimsModel,
    filters: Filters | None = None,
    series: tuple[int, int, int] = SERIES["care_manager_capacity"],
) -> DataFrame:
    """Every patient of the pool with place, running cost and the least capacity that enrols them.

    The list for one capacity is a filter on ``enrolled_from_capacity``; beyond the series
    it is NULL.
    """
    first, last, step = series
    pool = materialize(high_priority(model, filters))
    order = [("annual_cost", "desc"), ("beneficiary_id", "asc")]
    placed = running_totals(pool, order, ["annual_cost"])
    place = F.col("rows_up_to")
    steps = F.greatest(F.lit(0), F.ceil((place - first) / step))
    capacity = (F.lit(first) + steps * step).cast("bigint")
    return placed.select(
        "beneficiary_id",
        "chronic_condition_count",
        "annual_cost",
        place.alias("enrollment_place"),
        F.col("annual_cost_up_to").alias("running_cost"),
        F.when(capacity <= last, capacity).alias("enrolled_from_capacity"),
    )


def care_list(
    model: ClaimsModel, capacity: int = 5000, filters: Filters | None = None
) -> DataFrame:
    """The costliest patients of the pool, as many as can be enrolled."""
    return (
        high_priority(model, filters)
        .orderBy(F.desc("annual_cost"), "beneficiary_id")
        .limit(capacity)
    )


def disease_counts(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Patients with claims in scope per condition, every condition listed."""
    patients = model.beneficiaries.join(in_scope(model, filters), "beneficiary_key", "left_semi")
    counted = (
        unfold_conditions(patients, [], names="list")
        .groupBy("disease_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = conditions(model.fact.sparkSession).select("disease_name")
    return listed.join(counted, "disease_name", "left").select(
        "disease_name", F.coalesce("n", F.lit(0).cast("bigint")).alias("beneficiary_count")
    )


def briefing(model: ClaimsModel, threshold: int = 6, capacity: int = 5000) -> DataFrame:
    """One sentence over amount, fraud, exposure at the threshold, enrolment and review."""
    scores = provider_scores(model)
    above = F.col("risk_score") >= threshold
    reviewed = F.col("payment_decision").isin(*REVIEWED)

    def amount_if(condition) -> Column:
        return F.coalesce(
            F.sum(F.when(condition, F.col("total_reimbursement"))), F.lit(0).cast("bigint")
        )

    flagged = F.col("is_potential_fraud")
    one = scores.agg(
        F.sum("total_reimbursement").alias("amount"),
        F.count_if(flagged).alias("fraud_providers"),
        F.count(F.lit(1)).alias("providers"),
        amount_if(flagged).alias("fraud_amount"),
        F.count_if(above).alias("n_above"),
        amount_if(above).alias("amount_above"),
        amount_if(reviewed).alias("amount_review"),
    ).withColumn(
        "enrolled", care_capacity(model, capacity).select("recommended_enrollment").scalar()
    )

    def millions(name: str) -> Column:
        return F.format_number(F.col(name) / 1000000, 1)

    return one.select(
        F.format_string(
            "Reimbursement: $%sM | Fraud: %.1f%% ($%sM, %.1f%% of total) | "
            "At Threshold: %s providers ($%sM) | Care Mgmt: %s enrolled | Billing Review: $%sM",
            millions("amount"),
            F.col("fraud_providers") / F.col("providers") * 100,
            millions("fraud_amount"),
            F.col("fraud_amount") / F.col("amount") * 100,
            F.format_number("n_above", 0),
            millions("amount_above"),
            F.format_number("enrolled", 0),
            millions("amount_review"),
        ).alias("briefing")
    )


