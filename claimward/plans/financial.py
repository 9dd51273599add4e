"""Financial exposure: waterfall, outliers, cost drivers, benchmarks, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.functions.columns import choose, mean, percent, ratio, relative
from claimward.functions.ranks import with_rank
from claimward.model import PROVIDER, ClaimsModel
from claimward.plans.provider import overall_mean, stored_profile

AMOUNT = "claim_reimbursement_amt"
DEFAULT_CAPS = [10000, 20000, 30000, 40000, 50000]


def waterfall(model: ClaimsModel) -> DataFrame:
    """Total, unflagged, flagged, and unflagged with an average beyond mean + 2 sd."""
    providers = stored_profile(model, "total_reimbursement", "avg_reimbursement")
    bound = providers.agg(
        F.avg("avg_reimbursement") + 2 * F.stddev_samp("avg_reimbursement")
    ).scalar()
    flagged = F.col("is_potential_fraud")
    marked = providers.withColumn("is_high", ~flagged & (F.col("avg_reimbursement") > bound))
    zero = F.lit(0).cast("bigint")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("total_reimbursement"))), zero)

    sums = marked.agg(
        F.sum("total_reimbursement").alias("all_sum"),
        total(~flagged).alias("clean_sum"),
        total(flagged).alias("fraud_sum"),
        total(F.col("is_high")).alias("high_sum"),
    )
    return sums.selectExpr(
        "stack(4, 'Total Reimbursement', all_sum, 1, 'Non-Fraud Providers', clean_sum, 2, "
        "'Fraud Labeled Providers', fraud_sum, 3, 'High Risk (Unlabeled)', high_sum, 4) "
        "as (category, amount, sort_order)"
    )


def outliers(model: ClaimsModel) -> DataFrame:
    """Provider totals against mean and standard deviation of provider totals."""
    providers = stored_profile(model, "total_reimbursement", "total_claims", "avg_reimbursement")
    stats = providers.agg(
        F.struct(
            mean("total_reimbursement").alias("m"),
            F.stddev_samp("total_reimbursement").alias("s"),
        )
    ).scalar()
    scored = with_rank(providers, [("total_reimbursement", "asc")], percent="position")
    total = F.col("total_reimbursement")
    return (
        scored.withColumn("stats", stats)
        .withColumn("mean_raw", F.col("stats.m"))
        .withColumn("sd_raw", F.col("stats.s"))
        .select(
            *PROVIDER,
            "total_reimbursement",
            "total_claims",
            F.col("avg_reimbursement").alias("avg_reimbursement_per_claim"),
            F.round("mean_raw", 6).alias("mean_reimbursement"),
            F.round("sd_raw", 6).alias("stddev_reimbursement"),
            F.round(F.col("mean_raw") + F.col("sd_raw"), 6).alias("mean_plus_1sd"),
            F.round(F.col("mean_raw") + 2 * F.col("sd_raw"), 6).alias("mean_plus_2sd"),
            F.round(ratio(total - F.col("mean_raw"), "sd_raw"), 6).alias("z_score"),
            choose(
                [
                    (total > F.col("mean_raw") + 2 * F.col("sd_raw"), "Extreme Outlier (>2 SD)"),
                    (total > F.col("mean_raw") + F.col("sd_raw"), "Outlier (>1 SD)"),
                    (total > F.col("mean_raw"), "Above Average"),
                ],
                "Below Average",
            ).alias("outlier_category"),
            F.round(F.col("position") * 100, 6).alias("percentile_rank"),
        )
    )


def cost_drivers(model: ClaimsModel) -> DataFrame:
    """Amount by claim type, region, fraud label and age group in a single pass.

    The claims are first added up per combination of the four attributes (a few hundred
    rows at any scale); only those rows are unfolded into one row per attribute.
    """
    combos = model.claims.groupBy("claim_type", "region", "fraud_label", "age_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(AMOUNT).alias("amt"),
        F.count(AMOUNT).alias("paid"),
    )
    long = combos.unpivot(
        ["n", "amt", "paid"],
        [
            F.col("claim_type").alias("Claim Type"),
            F.col("region").alias("Region"),
            F.col("fraud_label").alias("Fraud Label"),
            F.col("age_group").alias("Age Group"),
        ],
        "dimension",
        "dimension_value",
    ).filter("dimension <> 'Region' or dimension_value is not null")
    grouped = long.groupBy("dimension", "dimension_value").agg(
        F.sum("n").alias("total_claims"),
        F.sum("amt").alias("total_reimbursement"),
        ratio(F.sum("amt"), F.sum("paid")).alias("avg_reimbursement"),
    )
    whole = F.sum("total_reimbursement").over(Window.partitionBy("dimension"))
    return grouped.withColumn("reimbursement_pct", percent("total_reimbursement", whole))


def benchmark(model: ClaimsModel) -> DataFrame:
    """Every provider against the average over all claims."""
    providers = stored_profile(
        model,
        "total_claims",
        "unique_beneficiaries",
        "total_reimbursement",
        "paid_claims",
        "avg_reimbursement",
        "deceased_patient_claims",
        "same_day_discharges",
        "avg_diagnosis_codes",
        "ip_claims",
        beneficiaries=True,
    )
    average = overall_mean(providers, "total_reimbursement", "paid_claims")
    ranked = with_rank(providers, [("total_reimbursement", "desc")], rank="reimbursement_rank")
    ranked = with_rank(ranked, [("avg_reimbursement", "desc")], rank="avg_reimbursement_rank")
    own, base = F.col("avg_reimbursement"), F.col("global_avg_reimbursement")
    return (
        ranked.withColumn("global_avg_reimbursement", average)
        .withColumn("vs_benchmark_amt", own - base)
        .withColumn("vs_benchmark_pct", relative(own, base))
        .withColumn(
            "benchmark_category",
            choose(
                [
                    (own > base * 2, "Critical: >200% of Average"),
                    (own > base * 1.5, "High: >150% of Average"),
                    (own > base * 1.2, "Elevated: >120% of Average"),
                    (own > base, "Above Average"),
                ],
                "At or Below Average",
            ),
        )
        # without inpatient claims there is no same-day information at all
        .withColumn("same_day_discharges", F.when(F.col("ip_claims") > 0, F.col("same_day_discharges")))
        .withColumnRenamed("avg_reimbursement", "avg_reimbursement_per_claim")
        .drop("provider_key", "paid_claims", "ip_claims")
    )


def cap_grid(model: ClaimsModel, caps: list[int]) -> DataFrame:
    """Saving for every cap from one pass over the claims.

    The caps become aggregate columns and are unfolded from the single result row, so the
    claims are not repeated once per cap.
    """
    amount = F.col(AMOUNT)
    zero = F.lit(0).cast("bigint")
    measures = [F.count(F.lit(1)).alias("claims"), F.coalesce(F.sum(amount), zero).alias("actual")]
    for cap in caps:
        limited = F.when(amount > cap, F.lit(cap).cast("bigint")).otherwise(amount)
        measures.append(F.coalesce(F.sum(limited), zero).alias(f"capped_{cap}"))
        measures.append(F.count_if(amount > cap).alias(f"above_{cap}"))
    one = model.fact.agg(*measures)
    rows = F.array(
        *[
            F.struct(
                F.lit(cap).cast("int").alias("cap_amount"),
                F.col("actual").alias("actual_total"),
                F.col(f"capped_{cap}").alias("capped_total"),
                (F.col("actual") - F.col(f"capped_{cap}")).alias("potential_savings"),
                F.col(f"above_{cap}").alias("claims_above_cap"),
                percent(f"above_{cap}", "claims").alias("pct_claims_affected"),
            )
            for cap in caps
        ]
    )
    return one.select(F.inline(rows))


def cap_scenarios(model: ClaimsModel) -> DataFrame:
    return cap_grid(model, DEFAULT_CAPS)

