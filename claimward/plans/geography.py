"""Geography and trends: states, regions, monthly anomalies, seasons, fraud density."""

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
    ratio,
    relative,
    same_day,
)
from claimward.model import MONTH_KEY, STATE, ClaimsModel, name_months, with_month
from claimward.plans.executive import (
    by_month,
    distinct_flagged,
    flagged,
    monthly_totals,
    rolling_mean,
    running_total,
)

AMOUNT = "claim_reimbursement_amt"

def nation() -> WindowSpec:
    """Everything at once: used over one row per state, region or month only."""
    return Window.partitionBy()


def place(value: str | Column) -> Column:
    return F.rank().over(Window.orderBy(F.desc_nulls_last(value))).cast("bigint")


def states(model: ClaimsModel) -> DataFrame:
    """Volume, finance and signals per state against all claims with a state."""
    per_state = (
        model.joined("beneficiary", "state").filter("geo_key is not null")
        .groupBy(*STATE, "state_code")
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.count_distinct("provider_key").alias("unique_providers"),
            F.count_distinct("beneficiary_key").alias("unique_beneficiaries"),
            F.count_if(is_inpatient()).alias("ip_claims"),
            F.count_if(is_outpatient()).alias("op_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            F.count(AMOUNT).alias("paid"),
            mean(AMOUNT).alias("avg_reimbursement_per_claim"),
            F.sum("deductible_amt_paid").cast("double").alias("total_deductible"),
            distinct_flagged().alias("fraud_providers"),
            amount_when(flagged()).alias("fraud_reimbursement"),
            F.count_if("is_deceased").alias("deceased_patient_claims"),
            F.count_if(same_day()).alias("same_day_discharges"),
        )
        .withColumn("fraud_rate_pct", percent("fraud_providers", "unique_providers"))
        .withColumn(
            "national_avg_reimbursement",
            ratio(F.sum("total_reimbursement").over(nation()), F.sum("paid").over(nation())),
        )
    )
    own, base = F.col("avg_reimbursement_per_claim"), F.col("national_avg_reimbursement")
    return per_state.withColumns(
        {
            "vs_national_avg_amt": own - base,
            "vs_national_avg_pct": relative(own, base),
            "performance_flag": choose(
                [
                    (own > base * 1.3, "High Cost State"),
                    (own > base * 1.1, "Above Average"),
                    (own < base * 0.9, "Efficient State"),
                ],
                "Average",
            ),
            "reimbursement_rank": place("total_reimbursement"),
            "claim_volume_rank": place("total_claims"),
            "fraud_rate_rank": place("fraud_rate_pct"),
        }
    ).drop("paid")


def regions(model: ClaimsModel) -> DataFrame:
    """Regions against the national totals, which include claims without a state.

    All claims are grouped by region first and the national totals are taken over those
    few rows, so the claims are read once.
    """
    per_region = model.joined("state").groupBy("region").agg(
        F.count_distinct("state_code").alias("state_count"),
        F.count(F.lit(1)).alias("total_claims"),
        F.count_distinct("provider_key").alias("unique_providers"),
        F.count_distinct("beneficiary_key").alias("unique_beneficiaries"),
        F.sum(AMOUNT).alias("total_reimbursement"),
        F.count(AMOUNT).alias("paid"),
        mean(AMOUNT).alias("avg_reimbursement_per_claim"),
        distinct_flagged().alias("fraud_providers"),
    )
    with_totals = per_region.withColumns(
        {
            "nation_amount": F.sum("total_reimbursement").over(nation()),
            "nation_claims": F.sum("total_claims").over(nation()),
            "national_avg_reimbursement": ratio(
                F.sum("total_reimbursement").over(nation()), F.sum("paid").over(nation())
            ),
        }
    )
    own, base = F.col("avg_reimbursement_per_claim"), F.col("national_avg_reimbursement")
    return (
        with_totals.filter("region <> 'Unknown'")
        .withColumns(
            {
                "fraud_rate_pct": percent("fraud_providers", "unique_providers"),
                "vs_national_amt": own - base,
                "vs_national_pct": relative(own, base),
                "pct_of_national_reimbursement": percent("total_reimbursement", "nation_amount"),
                "pct_of_national_claims": percent("total_claims", "nation_claims"),
            }
        )
        .drop("paid", "nation_amount", "nation_claims")
    )


def trend_anomalies(model: ClaimsModel) -> DataFrame:
    """Monthly series with months beyond 1.5 standard deviations marked."""
    total = F.col("total_reimbursement")
    low = F.col("avg_raw") - 1.5 * F.col("sd_raw")
    high = F.col("avg_raw") + 1.5 * F.col("sd_raw")
    return (
        monthly_totals(model)
        .withColumn("avg_raw", F.avg(total).over(nation()))
        .withColumn("sd_raw", F.stddev_samp(total).over(nation()))
        .withColumn("prev_month_reimb", F.lag(total).over(by_month()))
        .withColumn("prev_month_claims", F.lag("total_claims").over(by_month()))
        .withColumn("rolling_3m_avg", rolling_mean("total_reimbursement"))
        .withColumn("cumulative_reimbursement", running_total("total_reimbursement"))
        .withColumn("reimbursement_mom_pct", relative(total, "prev_month_reimb"))
        .withColumn("claims_mom_pct", relative("total_claims", "prev_month_claims"))
        .withColumn(
            "anomaly_flag",
            choose(
                [(total > high, "Anomaly: Unusually High"), (total < low, "Anomaly: Unusually Low")],
                "Normal",
            ),
        )
        .withColumn("fraud_reimb_pct", percent("fraud_reimbursement", total))
        .withColumn("overall_avg", F.round("avg_raw", 6))
        .withColumn("overall_stddev", F.round("sd_raw", 6))
        .drop("avg_raw", "sd_raw")
    )


def quadrants(model: ClaimsModel) -> DataFrame:
    """States split at the median of claims and the median of amount."""
    per_state = (
        model.joined("state").filter("geo_key is not null")
        .groupBy(*STATE)
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement"),
            distinct_flagged().alias("fraud_provider_count"),
            F.count_distinct("provider_key").alias("total_providers"),
        )
        .withColumn("median_claims", F.percentile("total_claims", 0.5).over(nation()))
        .withColumn("median_reimbursement", F.percentile("total_reimbursement", 0.5).over(nation()))
    )
    many = F.col("total_claims") > F.col("median_claims")
    costly = F.col("total_reimbursement") > F.col("median_reimbursement")
    return per_state.withColumn(
        "quadrant",
        choose(
            [
                (many & costly, "High Volume High Cost"),
                (many, "High Volume Low Cost"),
                (costly, "Low Volume High Cost"),
            ],
            "Low Volume Low Cost",
        ),
    )


def seasons(model: ClaimsModel) -> DataFrame:
    """Month by year: share of the year, and distance from the month's usual average."""
    monthly = name_months(
        with_month(model.fact)
        .groupBy(*MONTH_KEY)
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum(AMOUNT).alias("total_reimbursement"),
            mean(AMOUNT).alias("avg_reimbursement"),
        )
    ).drop("year_month")
    year_total = F.sum("total_reimbursement").over(Window.partitionBy("year_num"))
    usual = F.avg("avg_reimbursement").over(Window.partitionBy("month_num"))
    return monthly.withColumn(
        "pct_of_year_total", percent("total_reimbursement", year_total)
    ).withColumn("vs_month_avg", F.round(F.col("avg_reimbursement") - usual, 6))


def fraud_density(model: ClaimsModel) -> DataFrame:
    """Flagged and clean providers per state.

    One row per state and provider first: every provider is then counted by plain
    conditional counts instead of three distinct counts.
    """
    pairs = (
        model.joined("state").filter("geo_key is not null")
        .groupBy(*STATE, "provider_key", "is_potential_fraud")
        .agg(F.sum(AMOUNT).alias("amount"))
    )
    return (
        pairs.groupBy(*STATE)
        .agg(
            F.count(F.lit(1)).alias("total_providers"),
            F.count_if(flagged()).alias("fraud_providers"),
            F.count_if(~flagged()).alias("clean_providers"),
            amount_when(flagged(), "amount").alias("fraud_reimbursement"),
            F.sum("amount").alias("total_reimbursement"),
        )
        .withColumn("fraud_rate_pct", percent("fraud_providers", "total_providers"))
        .withColumn("fraud_exposure_pct", percent("fraud_reimbursement", "total_reimbursement"))
        .withColumn("fraud_rate_rank", place("fraud_rate_pct"))
        .withColumn("fraud_exposure_rank", place("fraud_reimbursement"))
    )
